"""Score, filter and modify: the harness that applies rules and modifiers to a DataFrame.

Every step is a projection or a selection of Columns; a chain of them is one Spark stage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators.filters import Rule

Scorer = Rule | Callable[[Column], Column]


def _each(value, n: int, what: str) -> list:
    values = list(value) if isinstance(value, list | tuple) else [value] * n
    if len(values) != n:
        raise ValueError(f"{n} steps need {n} of {what}, not {len(values)}")
    return values


def _steps(steps) -> list:
    steps = list(steps) if isinstance(steps, list | tuple) else [steps]
    if not steps:
        raise ValueError("no steps")
    return steps


def require(df: DataFrame, columns: Sequence[str]) -> None:
    if missing := set(columns) - set(df.columns):
        raise ValueError(f"no columns {sorted(missing)}")


def score(df: DataFrame, rules: Scorer | list[Scorer], score_field: str | list[str], text_field: str | list[str] = "text") -> DataFrame:
    """One score column for each rule or Column function."""
    rules = _steps(rules)
    if len(rules) > 1 and isinstance(score_field, str):
        raise ValueError("several rules need a score field each")
    for rule, name, text in zip(rules, _each(score_field, len(rules), "score_field"), _each(text_field, len(rules), "text_field"), strict=True):
        require(df, [text])
        df = df.withColumn(name, (rule.score if isinstance(rule, Rule) else rule)(F.col(text)))
    return df


def select(df: DataFrame, rules: Scorer | list[Scorer], filter_field: str | list[str], invert: bool | list[bool] = False) -> DataFrame:
    """Rows whose field passes; an undecided row (null) doesn't, inverted or not."""
    rules = _steps(rules)
    for rule, name, turned in zip(rules, _each(filter_field, len(rules), "filter_field"), _each(invert, len(rules), "invert"), strict=True):
        require(df, [name])
        kept = (rule.keep if isinstance(rule, Rule) else rule)(F.col(name))
        df = df.where(~kept if turned else kept)
    return df


def score_filter(df: DataFrame, rules: Rule | list[Rule], text_field: str | list[str] = "text", score_field: str | list[str | None] | None = None, invert: bool | list[bool] = False) -> DataFrame:
    """Score and keep, by all rules; scores without a field are dropped.

    Words, lines and paragraphs that rules share are split once, and each score is computed once: both stand in struct
    columns behind an ``explode`` of one element, through which Catalyst neither pushes nor copies expressions. All of it
    is one stage.
    """
    rules = _steps(rules)
    texts, names, turned = (_each(v, len(rules), n) for v, n in ((text_field, "text_field"), (score_field, "score_field"), (invert, "invert")))
    require(df, set(texts) - {n for n in names if n})
    for k, text in enumerate(texts):
        if text in names[:k]:  # a rule of a score: those before it come first
            first = score_filter(df, rules[:k], texts[:k], names[:k], turned[:k])
            return score_filter(first, rules[k:], texts[k:], names[k:], turned[k:])
    splits = {text: T.Splits(F.col(text), _unused(df, f"_splits{i}")) for i, text in enumerate(dict.fromkeys(texts))}
    scores = []
    for k, (rule, text) in enumerate(zip(rules, texts, strict=True)):
        with splits[text].shared():
            scores.append(rule.score(splits[text].text).alias(f"s{k}"))
    out, fields = df, df.columns
    for split in splits.values():
        if split.fields:
            out = out.select("*", F.explode(F.array(split.column())).alias(split.name))
    scored = _unused(df, "_scores")
    out = out.select(*fields, F.explode(F.array(F.struct(*scores))).alias(scored))
    for k, (rule, inverted) in enumerate(zip(rules, turned, strict=True)):
        kept = rule.keep(F.col(scored)[f"s{k}"])
        out = out.where(~kept if inverted else kept)
    put = {name: F.col(scored)[f"s{k}"].alias(name) for k, name in enumerate(names) if name}
    return out.select(*[put.get(c, F.col(c)) for c in fields], *[v for n, v in put.items() if n not in fields])


def _unused(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def modify(df: DataFrame, modifiers: Callable[..., Column] | list[Callable[..., Column]], input_fields: str | list = "text", output_fields: str | list[str | None] | None = None) -> DataFrame:
    """Apply Column functions; one of several inputs takes them in order and needs an output field."""
    modifiers = _steps(modifiers)
    inputs = input_fields if isinstance(input_fields, list) and len(input_fields) == len(modifiers) and (len(modifiers) > 1 or isinstance(input_fields[0], list)) else [input_fields] * len(modifiers)
    for step, fields, out in zip(modifiers, inputs, _each(output_fields, len(modifiers), "output_fields"), strict=True):
        fields = [fields] if isinstance(fields, str) else list(fields)
        require(df, fields)
        if out is None and len(fields) > 1:
            raise ValueError("several input fields need an output field")
        df = df.withColumn(out or fields[0], step(*map(F.col, fields)))
    return df


_COMPARE = {"lt": "__lt__", "le": "__le__", "eq": "__eq__", "ne": "__ne__", "ge": "__ge__", "gt": "__gt__"}


def preserve_by_value(df: DataFrame, field: str, value: int | float | str, operator: str = "eq") -> DataFrame:
    """Rows where ``field operator value`` holds."""
    if operator not in _COMPARE:
        raise ValueError(f"operator {operator!r} is none of {sorted(_COMPARE)}")
    return df.where(getattr(F.col(field), _COMPARE[operator])(F.lit(value)))
