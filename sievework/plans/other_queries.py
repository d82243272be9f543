"""Queries of sources and sinks, extraction, interleaved rows, segments, model adapters and translation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.operators import interleaved, models, segments, translation
from sievework.plans.filter_queries import strip
from sievework.plans.tables import fresh_path, table
from sievework.sources import extract, readers, writers


def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), fresh_path(spark, "jsonl")
    writers.write_jsonl(docs, path, ["doc_id", "text", "lang"])
    return readers.read_jsonl(spark, path, schema="doc_id long, text string, lang string").select("doc_id", F.md5("text").alias("md5"), "lang")


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "parquet")
    writers.write_parquet(table(spark, sf_dir, "lineitem"), path, ["l_orderkey", "l_quantity", "l_returnflag"])
    return readers.read_parquet(spark, path, ["l_orderkey", "l_quantity"]).where("l_quantity >= 49")


def webdataset_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tar")
    writers.write_webdataset(_turn_rows(spark, sf_dir), path, 4)
    rows = readers.read_webdataset(spark, path)
    return rows.where("modality = 'text'").groupBy("sample_id").agg(F.count("*").alias("texts"), F.sum(F.length("text_content")).alias("chars"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_html(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "language", F.length("text").alias("n"))


def html_dense_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_html(table(spark, sf_dir, "pages").select("page_id", "html"), algorithm="density").select("page_id", "language", F.length("text").alias("n"))


def _turn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as interleaved rows: a metadata row, and a text row for each turn; tool turns stand for images."""
    turns = table(spark, sf_dir, "conversations")
    text = turns.select(F.col("conv_id").cast("string").alias("sample_id"), F.col("turn").cast("int").alias("position"), F.when(F.col("turn") % 3 == 2, "image").otherwise("text").alias("modality"), F.col("text").alias("text_content"))
    meta = turns.select(F.col("conv_id").cast("string").alias("sample_id")).distinct().select("sample_id", F.lit(-1).alias("position"), F.lit("metadata").alias("modality"), F.lit("{}").alias("text_content"))
    return readers.align_interleaved(text.withColumn("text_content", F.when(F.col("modality") == "text", F.col("text_content"))).unionByName(meta))


_TURNS = """WITH t AS (SELECT conv_id::VARCHAR AS sample_id, turn::INTEGER AS position, CASE WHEN turn % 3 = 2 THEN 'image' ELSE 'text' END AS modality,
  CASE WHEN turn % 3 = 2 THEN NULL ELSE text END AS text_content FROM conversations)"""


def interleaved_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turn_rows(spark, sf_dir)
    return interleaved.keep_rows(rows, (F.col("modality") != "text") | (F.length("text_content") >= 60)).select("sample_id", "position", "modality", F.length("text_content").alias("n"))


def interleaved_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved.image_to_text_ratio(_turn_rows(spark, sf_dir), 0.0, 0.02).select("sample_id", "position", "modality")


def _recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as a recording: a segment for each, in whole seconds from a fixed day on."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"), "value", "event_type")
    segment = F.struct((F.col("at") % 86400).cast("double").alias("start"), (F.col("at") % 86400 + F.pmod(F.col("event_id"), F.lit(600)) + 1).cast("double").alias("end"), F.col("event_type").alias("speaker"), F.col("event_type").alias("text"), F.col("event_id"))
    return e.groupBy("user_id").agg(F.array_sort(F.collect_list(segment)).alias("segments"))


_SEGMENTS = """WITH s AS (SELECT user_id, event_id, (floor(epoch(ts))::BIGINT % 86400)::DOUBLE AS a, (floor(epoch(ts))::BIGINT % 86400 + event_id % 600 + 1)::DOUBLE AS b FROM events)"""


def segment_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _recordings(spark, sf_dir)
    pairs = segments.overlap_pairs(rec, "user_id").join(rec.select(F.col("user_id").alias("id"), "segments"), "id")
    of = lambda c: F.element_at("segments", F.col(c) + 1)["event_id"]
    return pairs.select(F.col("id").alias("user_id"), F.least(of("i"), of("j")).alias("a"), F.greatest(of("i"), of("j")).alias("b"))


def segments_without_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.drop_overlaps(_recordings(spark, sf_dir), id_field="user_id").select("user_id", F.explode("segments").alias("s")).select("user_id", "s.event_id")


def snippet_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = segments.plan_snippets(segments.drop_overlaps(_recordings(spark, sf_dir), id_field="user_id"), longest=3600.0, widest_gap=900.0)
    return planned.select("user_id", "snippet.start", "snippet.end", F.size("snippet.segments").alias("n"))


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("path"), F.col("p_size").cast("double").alias("duration"))
    return segments.fixed_stride(parts, length=10.0, stride=5.0, shortest=2.0).select("path", "clip_start", "clip_end")


def character_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return names.select("p_partkey", segments.error_rates("p_type", "p_brand", True).alias("cer"))


def word_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    after = turns.withColumn("next", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    return after.select("conv_id", "turn", segments.error_rates("text", "next").alias("wer"))


def hallucinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("pred_text"), F.lit(10.0).alias("duration"))
    return segments.hallucination_reasons(turns, ["thank you"]).select("conv_id", "turn", F.array_join("hallucination", ",").alias("reasons"))


def _by_length():
    import numpy as np

    return lambda texts: np.array([[len(t), 1000.0, 200.0] for t in texts]) / 100.0


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in model whose logits are a text's length and two constants."""
    classifier = models.Classifier(_by_length, **models.QUALITY)
    return classifier(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "quality_pred")


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = models.embed(table(spark, sf_dir, "documents").select("doc_id", "text"), models.hashed_vector(32))
    return got.select("doc_id", F.size("embeddings").alias("n"))


def labelled_high_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.judge_filters(table(spark, sf_dir, "labels"), [{"field": "quality", "operator": "gte", "value": 1}, {"field": "toxic", "operator": "not_in", "value": [1]}])


def _brackets():
    return lambda lines: [f"[{s}]" for s in lines]


def translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in translator that writes brackets."""
    turns = table(spark, sf_dir, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    return translation.translate(turns.select("id", "text"), _brackets, "id", shortest=20).select("id", F.md5("translated_text").alias("md5"))


QUERIES = {
    "jsonl_round_trip": jsonl_round_trip,
    "parquet_round_trip": parquet_round_trip,
    "webdataset_round_trip": webdataset_round_trip,
    "html_text": html_text,
    "html_dense_text": html_dense_text,
    "interleaved_filter": interleaved_filter,
    "interleaved_image_to_text_ratio": interleaved_ratio,
    "segment_overlaps": segment_overlaps,
    "segments_without_overlaps": segments_without_overlaps,
    "snippet_plan": snippet_plan,
    "fixed_stride_clips": clips,
    "character_error_rates": character_error_rates,
    "word_error_rates": word_error_rates,
    "hallucination_reasons": hallucinations,
    "classifier_adapter": classified,
    "embedding_adapter": embedded,
    "judge_filters": labelled_high_quality,
    "translation_adapter": translated,
}
_PAIRS = f"""{_SEGMENTS}, p AS (SELECT x.user_id, least(x.event_id, y.event_id) AS a, greatest(x.event_id, y.event_id) AS b FROM s x JOIN s y
ON x.user_id = y.user_id AND x.event_id < y.event_id AND x.a < y.b AND y.a < x.b
AND (least(x.b, y.b) - greatest(x.a, y.a) >= 0.5 OR (x.a <= y.a AND x.b >= y.b) OR (y.a <= x.a AND y.b >= x.b)))"""
ORACLE_SQL = {
    "jsonl_round_trip": "SELECT doc_id, md5(text) AS md5, lang FROM documents",
    "parquet_round_trip": "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 49",
    "webdataset_round_trip": f"{_TURNS} SELECT sample_id, count(*) AS texts, sum(length(text_content))::BIGINT AS chars FROM t WHERE modality = 'text' GROUP BY sample_id",
    "interleaved_filter": f"""{_TURNS}, k AS (SELECT * FROM t WHERE modality <> 'text' OR length(text_content) >= 60)
SELECT sample_id, (row_number() OVER (PARTITION BY sample_id ORDER BY position) - 1)::INTEGER AS position, modality, length(text_content)::INTEGER AS n FROM k
UNION ALL SELECT DISTINCT sample_id, -1, 'metadata', 2 FROM k""",
    "interleaved_image_to_text_ratio": f"""{_TURNS}, r AS (SELECT sample_id, count(*) FILTER (modality = 'image') AS images, coalesce(sum(len(regexp_extract_all(text_content, '[^\\s]+'))), 0) AS words FROM t GROUP BY sample_id),
k AS (SELECT t.* FROM t JOIN r USING (sample_id) WHERE images / greatest(words, 1) BETWEEN 0 AND 0.02)
SELECT sample_id, (row_number() OVER (PARTITION BY sample_id ORDER BY position) - 1)::INTEGER AS position, modality FROM k
UNION ALL SELECT DISTINCT sample_id, -1, 'metadata' FROM k""",
    "segment_overlaps": f"{_PAIRS} SELECT * FROM p",
    "segments_without_overlaps": f"{_PAIRS} SELECT user_id, event_id FROM s WHERE event_id NOT IN (SELECT a FROM p UNION SELECT b FROM p)",
    "fixed_stride_clips": """SELECT p_partkey AS path, i * 5.0::DOUBLE AS clip_start, least(i * 5.0 + 10.0, p_size)::DOUBLE AS clip_end
FROM part, range(0, 100) r(i) WHERE i * 5.0 < p_size AND least(i * 5.0 + 10.0, p_size) - i * 5.0 >= 2""",
    "character_error_rates": "SELECT p_partkey, round(100.0 * levenshtein(p_brand, p_type) / greatest(length(p_type), 1), 4)::DOUBLE AS cer FROM part",
    "classifier_adapter": "SELECT doc_id, CASE WHEN least(length(text), 6000) >= 1000 THEN 'High' ELSE 'Medium' END AS quality_pred FROM documents",
    "embedding_adapter": "SELECT doc_id, 32 AS n FROM documents",
    "judge_filters": "SELECT * FROM labels WHERE quality >= 1 AND toxic NOT IN (1)",
    "translation_adapter": f"""SELECT conv_id * 1000 + turn AS id, md5(array_to_string(list_transform(string_split(text, chr(10)),
lambda x: CASE WHEN length(x) >= 20 AND regexp_matches(x, '\\p{{L}}') AND NOT (starts_with({strip('x')}, '<') AND ends_with({strip('x')}, '>')) THEN concat(chr(91), x, chr(93)) ELSE x END), chr(10))) AS md5 FROM conversations""",
}
