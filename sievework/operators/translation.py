"""Translation: segments of a text are translated by an adapter and put back in place."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators.models import infer
from sievework.operators.segments import fold


def translatable(line: Column) -> Column:
    """Lines with a letter that are neither a tag nor a JSON object or array."""
    s = T.strip(line)
    tag = s.startswith("<") & s.endswith(">")
    braces = (s.startswith("{") & s.endswith("}")) | (s.startswith("[") & s.endswith("]"))
    return s.rlike(T.ALPHABETIC) & ~tag & ~(braces & F.try_parse_json(s).isNotNull())


def segment(df: DataFrame, id_field: str, text_field: str = "text", shortest: int = 0, skip_field: str | None = None) -> DataFrame:
    """``(id, place, line, translate)``: a row for each line of a text, marked if it is to be translated."""
    wanted = translatable(F.col("line")) & (F.length("line") >= shortest)
    if skip_field:
        wanted &= ~F.coalesce(F.col("_skip"), F.lit(False))
    skip = [F.col(skip_field).alias("_skip")] if skip_field else []
    rows = df.select(F.col(id_field).alias("id"), *skip, F.posexplode(F.split(F.coalesce(text_field, F.lit("")), "\n", -1)).alias("place", "line"))
    return rows.withColumn("translate", wanted).drop("_skip")


def translate_segments(segments: DataFrame, factory: Callable[[], Callable[[list[str]], list[str]]], batch: int = 64) -> DataFrame:
    """Segments with ``translation``; equal lines are translated once, others than those marked stay."""
    lines = segments.where("translate").select("line").distinct()
    done = lines.withColumn("_t", infer(factory, "string", batch)(F.col("line")))
    return segments.join(done, "line", "left").withColumn("translation", F.when(F.col("translate"), F.coalesce("_t", "line")).otherwise(F.col("line"))).drop("_t")


def reassemble(df: DataFrame, translated: DataFrame, id_field: str, out: str = "translated_text") -> DataFrame:
    """``df`` with its lines' translations joined in place."""
    joined = translated.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "translation"))), lambda s: s["translation"]), "\n").alias(out))
    return df.drop(out).join(joined.withColumnRenamed("id", id_field), id_field, "left")


def translate(df: DataFrame, factory: Callable[[], Callable[[list[str]], list[str]]], id_field: str, text_field: str = "text", out: str = "translated_text", shortest: int = 0, skip_existing: bool = False) -> DataFrame:
    """Whole texts translated line by line; rows that have a translation may be left as they are."""
    if skip_existing and out in df.columns:
        has = F.coalesce(F.trim(out), F.lit("")) != ""
        return translate(df.where(~has), factory, id_field, text_field, out, shortest).unionByName(df.where(has), allowMissingColumns=True)
    return reassemble(df, translate_segments(segment(df, id_field, text_field, shortest), factory), id_field, out)


def translate_field(df: DataFrame, factory: Callable[[], Callable[[list[str]], list[str]]], id_field: str, messages: str = "messages", content: str = "content") -> DataFrame:
    """An array of messages with each one's content translated: the path ``messages.*.content``."""
    rows = df.select(F.col(id_field).alias("_id"), F.posexplode(messages).alias("_n", "_m"))
    rows = rows.withColumn("_key", F.concat_ws("/", F.col("_id").cast("string"), "_n")).withColumn("text", F.col(f"_m.{content}"))
    done = translate(rows, factory, "_key").withColumn("_m", F.col("_m").withField(content, F.col("translated_text")))
    back = done.groupBy("_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_m"))), lambda s: s["_m"]).alias(messages))
    return df.drop(messages).join(back.withColumnRenamed("_id", id_field), id_field, "left")


#: What a translation is judged by, 1 to 5 each: fixed values.
FAITH = ("Fluency", "Accuracy", "Idiomaticity", "Terminology", "Handling_of_Format")


def faith_scores(answer: Column) -> Column:
    """Mean of the five scores in a judge's JSON answer; null where one is missing."""
    marks = [F.get_json_object(answer, f"$.{k}").try_cast("double") for k in FAITH]
    total = marks[0]
    for m in marks[1:]:
        total = total + m
    return total / len(FAITH)


def faith_threshold(df: DataFrame, score_field: str = "faith_avg", failed_field: str = "faith_parse_failed", least: float = 2.5) -> DataFrame:
    """Rows scored ``least`` or more, unscored, or whose answer couldn't be read."""
    failed = F.coalesce(F.col(failed_field), F.lit(False)) if failed_field in df.columns else F.lit(False)
    return df.where(F.col(score_field).isNull() | failed | (F.col(score_field) >= least))


def merge_scores(df: DataFrame, scores: list[str], metadata: str = "translation_metadata") -> DataFrame:
    """Scores put into a JSON column under ``faith_scores``."""

    def run(values, raw):
        return json.dumps((json.loads(raw) if raw else {}) | {"faith_scores": values}, ensure_ascii=False)

    old = F.col(metadata) if metadata in df.columns else F.lit(None).cast("string")
    return df.withColumn(metadata, fold(run, "string")(F.struct(*scores), old))


def format_output(df: DataFrame, target_lang: str, mode: str = "replaced", text_field: str = "text", out: str = "translated_text", metadata: str = "translation_metadata") -> DataFrame:
    """The translation in place of the text (replaced), in JSON beside it (raw), or both."""
    if mode not in ("replaced", "raw", "both"):
        raise ValueError(f"mode {mode!r} is none of replaced, raw, both")
    if mode != "replaced":
        df = df.withColumn(metadata, F.to_json(F.struct(F.lit(target_lang).alias("target_lang"), F.struct(F.col(out).alias("content")).alias("translation"))))
    if mode != "raw":
        df = df.withColumn(text_field, F.coalesce(out, text_field))
    return df.drop(out)


def _grams(items, n: int):
    from collections import Counter

    return Counter(tuple(items[i : i + n]) for i in range(len(items) - n + 1))


def chrf(hypothesis: str, reference: str, order: int = 6, beta: float = 2.0) -> float:
    """chrF in percent: F of character n-grams up to ``order``, blanks left out."""
    a, b = "".join(hypothesis.split()), "".join(reference.split())
    precision, recall = [], []
    for n in range(1, order + 1):
        x, y = _grams(a, n), _grams(b, n)
        if x and y:
            hits = sum((x & y).values())
            precision.append(hits / sum(x.values()))
            recall.append(hits / sum(y.values()))
    if not precision or not sum(precision) + sum(recall):
        return 0.0
    p, r = sum(precision) / len(precision), sum(recall) / len(recall)
    return 100 * (1 + beta**2) * p * r / (beta**2 * p + r) if p + r else 0.0


def bleu(hypothesis: str, reference: str, order: int = 4) -> float:
    """Sentence BLEU in percent, orders without a hit smoothed by halves."""
    import math

    a, b = hypothesis.split(), reference.split()
    if not a or not b:
        return 0.0
    logs, smooth = [], 1.0
    for n in range(1, min(order, len(a)) + 1):
        x, y = _grams(a, n), _grams(b, n)
        hits, total = sum((x & y).values()), sum(x.values())
        if not hits:
            smooth *= 2
        logs.append(math.log(hits / total if hits else 1 / (smooth * total)))
    return 100 * math.exp(min(0.0, 1 - len(b) / len(a)) + sum(logs) / len(logs))


def ter(hypothesis: str, reference: str) -> float:
    """Word edits to the reference's words in percent, without shifts."""
    from sievework.operators.segments import word_error_rate

    return word_error_rate(reference, hypothesis)


METRICS: dict[str, tuple[Callable[[str, str], float], bool]] = {"bleu": (bleu, True), "chrf": (chrf, True), "ter": (ter, False)}


def _pairwise(function: Callable[[str, str], float]) -> Callable[..., Column]:
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else function(x, y) for x, y in zip(a, b, strict=True)], dtype="object")

    run.__annotations__ = dict.fromkeys(("a", "b", "return"), pd.Series)
    return F.pandas_udf(run, "double")


def quality_metrics(df: DataFrame, metrics: dict[str, float], reference: str = "text", hypothesis: str = "backtranslated_text", passed: str = "is_quality_metric_passed", keep_passed: bool = False) -> DataFrame:
    """``score_<metric>`` and ``<metric>_passed`` of each metric and its threshold, and whether all passed."""
    fine = F.lit(True)
    for name, threshold in metrics.items():
        function, higher = METRICS[name]

        df = df.withColumn(f"score_{name}", _pairwise(function)(hypothesis, reference))
        df = df.withColumn(f"{name}_passed", F.col(f"score_{name}") >= threshold if higher else F.col(f"score_{name}") <= threshold)
        fine &= F.coalesce(F.col(f"{name}_passed"), F.lit(False))
    df = df.withColumn(passed, fine)
    return df.where(passed) if keep_passed else df


def restore_order(df: DataFrame, order_field: str) -> DataFrame:
    return df.orderBy(order_field).drop(order_field)


def number_rows(df: DataFrame, order_by: str, out: str = "_order") -> DataFrame:
    """Places of rows within their partition of a range of ``order_by``."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(F.spark_partition_id()).orderBy(order_by)))
