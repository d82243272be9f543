"""Model-backed operators as adapters: a model is a function of a batch; Spark gives it batches and applies its results.

A factory makes the model once for each worker process. The reference models' weights aren't part of this library.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.filters import Rule

_made: dict[str, object] = {}


def _model(name: str, factory: Callable[[], Callable]) -> Callable:
    """A worker's model by the name its operator was given; a later operator's name is another."""
    if name not in _made:
        _made[name] = factory()
    return _made[name]


def infer(factory: Callable[[], Callable[[list], list]], kind: str, batch: int = 256, sort_by_length: bool = True) -> Callable[[Column], Column]:
    """A Column function of a model ``list -> list``. Texts of near lengths share a batch; results keep their rows' order."""
    name, fields = uuid.uuid4().hex, kind.startswith("struct<")

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(name, factory)
        for values in series:
            items = values.tolist()
            order = sorted(range(len(items)), key=lambda i: (len(items[i] or ""), i)) if sort_by_length else range(len(items))
            order, out = list(order), [None] * len(items)
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                for i, got in zip(part, model([items[i] or "" for i in part]), strict=True):
                    out[i] = got
            yield pd.DataFrame(out) if fields else pd.Series(out, dtype="object")

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.DataFrame if fields else pd.Series]}
    return F.pandas_udf(run, kind)


@dataclass(frozen=True)
class Classifier:
    """Labels of texts by the largest of a model's scores: ``factory()`` gives texts -> logits (n x labels)."""

    factory: Callable[[], Callable[[list[str]], np.ndarray]]
    labels: tuple[str, ...]
    label_field: str = "preds"
    score_field: str | None = None
    text_field: str = "text"
    max_chars: int | None = None
    filter_by: tuple[str, ...] | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        make = self.factory

        def probabilities():
            model = make()

            def run(texts: list[str]) -> list[list[float]]:
                z = np.asarray(model(texts), float)
                p = np.exp(z - z.max(1, keepdims=True))
                return (p / p.sum(1, keepdims=True)).tolist()

            return run

        text = F.col(self.text_field)
        text = F.substring(text, 1, self.max_chars) if self.max_chars else text
        out = df.withColumn("_p", infer(probabilities, "array<double>")(text))
        names = F.array(*map(F.lit, self.labels))
        out = out.withColumn(self.label_field, F.element_at(names, F.array_position("_p", F.array_max("_p")).cast("int")))
        out = out.withColumnRenamed("_p", self.score_field) if self.score_field else out.drop("_p")
        return out.where(F.col(self.label_field).isin(*self.filter_by)) if self.filter_by else out


#: Labels and crops of the public classifiers' families: fixed values.
QUALITY = {"labels": ("High", "Medium", "Low"), "label_field": "quality_pred", "max_chars": 6000}
DOMAIN = {"labels": ("Adult", "Arts_and_Entertainment", "Autos_and_Vehicles", "Beauty_and_Fitness", "Books_and_Literature", "Business_and_Industrial", "Computers_and_Electronics", "Finance", "Food_and_Drink", "Games", "Health", "Hobbies_and_Leisure", "Home_and_Garden", "Internet_and_Telecom", "Jobs_and_Education", "Law_and_Government", "News", "Online_Communities", "People_and_Society", "Pets_and_Animals", "Real_Estate", "Science", "Sensitive_Subjects", "Shopping", "Sports", "Travel_and_Transportation"), "label_field": "domain_pred", "max_chars": 2000}
CONTENT_TYPE = {"labels": ("Explanatory_Articles", "News", "Blogs", "Boilerplate_Content", "Analytical_Exposition", "Online_Comments", "Reviews", "Books_and_Literature", "Conversational", "Forums_and_Discussions", "MISC"), "label_field": "content_pred", "max_chars": 6000}


def educational_score(df: DataFrame, factory: Callable[[], Callable[[list[str]], list[float]]], prefix: str = "fineweb-edu-score", text_field: str = "text") -> DataFrame:
    """A regression as float and whole number from 0 to 5, and a label: high_quality from 2.5 on."""
    raw = df.withColumn("_s", infer(factory, "double")(F.col(text_field)))
    held = F.greatest(F.lit(0.0), F.least(F.lit(5.0), F.col("_s")))
    label = F.when(F.col("_s") >= 2.5, "high_quality").otherwise("low_quality")
    return raw.withColumns({f"{prefix}-float": held, f"{prefix}-int": F.bround(held, 0).cast("int"), f"{prefix}-label": label}).drop("_s")


#: Weights of a prompt's complexity: fixed values.
COMPLEXITY = {"creativity_scope": 0.35, "reasoning": 0.25, "constraint_ct": 0.15, "domain_knowledge": 0.15, "contextual_knowledge": 0.05, "number_of_few_shots": 0.05}


def prompt_complexity(df: DataFrame, out: str = "prompt_complexity_score") -> DataFrame:
    """Weighted sum of a prompt's scores, rounded to 5 digits."""
    total = F.lit(0.0)
    for name, weight in COMPLEXITY.items():
        total = total + F.col(name) * weight
    return df.withColumn(out, F.round(total, 5))


def safety_prompt(template: str, text_field: str = "text", max_chars: int = 6000) -> Column:
    """A prompt with the first characters of a text in place of ``{text}``."""
    before, _, after = template.partition("{text}")
    return F.concat(F.lit(before), F.substring(F.col(text_field), 1, max_chars), F.lit(after))


def safety_label(response: Column) -> Column:
    """safe, a hazard O1 to O13, or unknown, of a safety model's answer."""
    answer = F.lower(F.trim(response))
    hazard = F.upper(F.regexp_extract(answer, r"unsafe\s+(o(?:1[0-3]|[1-9]))\b", 1))
    return F.when(answer.startswith("safe"), "safe").when(hazard != "", hazard).otherwise("unknown")


def poisoned(score: Column, threshold: float = 0.5) -> Column:
    return score >= threshold


def embed(df: DataFrame, factory: Callable[[], Callable[[list[str]], list]], text_field: str = "text", out: str = "embeddings", max_chars: int | None = None, normalise: bool = True) -> DataFrame:
    """A model's vectors, of length 1 unless ``normalise`` is false."""
    text = F.substring(F.col(text_field), 1, max_chars) if max_chars else F.col(text_field)
    got = df.withColumn(out, infer(factory, "array<float>")(text))
    if not normalise:
        return got
    size = F.sqrt(F.aggregate(out, F.lit(0.0), lambda s, x: s + x * x))
    return got.withColumn("_n", size).withColumn(out, F.transform(out, lambda x: (x / F.greatest(F.col("_n"), F.lit(1e-12))).cast("float"))).drop("_n")


def mean_pool(vectors: Column, mask: Column) -> Column:
    """Mean of the token vectors that a mask marks."""
    kept = F.transform(F.filter(F.arrays_zip(vectors.alias("v"), mask.alias("m")), lambda z: z["m"] == 1), lambda z: z["v"])
    width = F.size(F.element_at(vectors, 1))
    return F.transform(F.sequence(F.lit(1), width), lambda i: F.aggregate(kept, F.lit(0.0), lambda s, v: s + F.element_at(v, i)) / F.size(kept))


def hashed_vector(size: int = 64) -> Callable[[], Callable[[list[str]], list]]:
    """A stand-in embedder: hashed word counts; the same for every run."""

    def make():
        import zlib

        def run(texts: list[str]) -> list:
            out = np.zeros((len(texts), size))
            for i, t in enumerate(texts):
                for w in t.lower().split():
                    h = zlib.crc32(w.encode())
                    out[i, h % size] += 1 if h >> 16 & 1 else -1
            return out.tolist()

        return run

    return make


def language(factory: Callable[[], Callable[[list[str]], list[tuple[float, str]]]], least: float = 0.3, lang: str | None = None) -> Rule:
    """Score and language of a text in a struct; kept from ``least`` on, of one language where given ("en" has every
    script of it)."""
    score = lambda t: infer(lambda: _as_structs(factory()), "struct<score:double,lang:string>")(F.replace(t, F.lit("\n"), F.lit(" ")))

    def keep(s: Column) -> Column:
        fine = s["score"] >= least
        if lang:
            found = F.lower(s["lang"])
            fine &= (found == lang.lower()) | F.startswith(found, F.lit(lang.lower() + "_"))
        return fine

    return Rule("language", score, keep)


def _as_structs(model: Callable[[list[str]], list[tuple[float, str]]]) -> Callable[[list[str]], list[dict]]:
    return lambda texts: [{"score": s, "lang": k} for s, k in model(texts)]


def quality_draw(factory: Callable[[], Callable[[list[str]], list[float]]], key: Column, alpha: float = 3.0, seed: int = 42) -> Rule:
    """Keeps a text if a Pareto draw exceeds 1 - score. The draw is a hash of ``key`` and the seed: reruns agree."""
    u = (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) + 1) / F.lit(float((1 << 30) + 1))
    return Rule("quality", infer(factory, "double"), lambda s: F.pow(u, F.lit(-1.0 / alpha)) - 1 > 1 - s)


def prompt_column(df: DataFrame, prompt: str, factory: Callable[[], Callable[[list[str]], list[str]]], input_field: str = "text", output_field: str = "generated") -> DataFrame:
    """A language model's answers to a template that holds ``{document}``."""
    before, _, after = prompt.partition("{document}")
    return df.withColumn(output_field, infer(factory, "string")(F.concat(F.lit(before), F.coalesce(F.col(input_field), F.lit("")), F.lit(after))))


def knowledge_list(text: Column) -> Column:
    """Lines of a bullet list without their bullets: a first line that isn't a bullet goes, indents of 2 are taken off."""
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda s, i: (i > 0) | s.startswith("-"))
    return F.trim(F.array_join(F.transform(kept, lambda s: F.when(s.startswith("- ") | s.startswith("  "), F.substring(s, F.lit(3), F.length(s))).otherwise(s)), "\n"))


def question_answers(df: DataFrame, qa_field: str, id_field: str, text_field: str = "text", prefix: str = "", most: int = 10, seed: int = 42) -> DataFrame:
    """Texts followed by up to ``most`` question and answer pairs of a generated list, in an order seeded by id; rows
    without a pair are dropped."""

    def run(texts: pd.Series, answers: pd.Series, keys: pd.Series) -> pd.Series:
        import random
        import re

        out = []
        for text, raw, key in zip(texts, answers, keys, strict=True):
            body = (raw or "").strip().removeprefix(prefix).strip()
            pairs = [p for p in re.split(r"\n(?=(?:[-*] )?Question:)", body) if re.match(r"(?:[-*] )?Question:", p) and re.search(r"^(?:[-*] )?Answer:", p, re.M)]
            pairs = [re.sub(r"(?m)^[-*] ", "", p).strip() for p in pairs]
            rng = random.Random(f"{seed} {key}")
            rng.shuffle(pairs)
            out.append(f"{text}\n\n" + "\n\n".join(pairs[: rng.randint(1, min(most, len(pairs)))]) if pairs else None)
        return pd.Series(out, dtype="object")

    run.__annotations__ = dict.fromkeys(("texts", "answers", "keys", "return"), pd.Series)
    out = df.withColumn(qa_field, F.pandas_udf(run, "string")(text_field, qa_field, F.col(id_field).cast("string")))
    return out.where(F.col(qa_field).isNotNull())


def multilingual_prompts(df: DataFrame, languages: list[str], template_field: str = "prompt") -> DataFrame:
    """A row for each language, its name in place of ``{language}``."""
    rows = df.withColumn("language", F.explode(F.array(*map(F.lit, languages))))
    return rows.withColumn(template_field, F.replace(F.col(template_field), F.lit("{language}"), F.col("language")))


_JUDGE = {"eq": lambda a, b: a == b, "ne": lambda a, b: a != b, "gt": lambda a, b: a > b, "gte": lambda a, b: a >= b, "lt": lambda a, b: a < b, "lte": lambda a, b: a <= b, "in": lambda a, b: a.isin(*b), "not_in": lambda a, b: ~a.isin(*b)}


def judge_filters(df: DataFrame, filters: list[dict]) -> DataFrame:
    """Rows for which each of {field, operator, value} holds; a field may be nested with dots; null doesn't hold."""
    for f in filters:
        if f["operator"] not in _JUDGE:
            raise ValueError(f"operator {f['operator']!r} is none of {sorted(_JUDGE)}")
        df = df.where(F.coalesce(_JUDGE[f["operator"]](F.col(f["field"]), f["value"]), F.lit(False)))
    return df


def score_limits(df: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows whose scores lie within (least, most) each: audio, image and video quality filters over model columns."""
    for name, (low, high) in limits.items():
        if low is not None:
            df = df.where(F.col(name) >= low)
        if high is not None:
            df = df.where(F.col(name) <= high)
    return df
