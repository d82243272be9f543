"""Queries of modifiers, row-shape operators and deduplication, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators import dedup, harness, modifiers, shape
from sievework.plans.filter_queries import PARAGRAPHS, POLICY, WS, strip
from sievework.plans.tables import table


_BETWEEN = "substring(text, position('the' IN text), greatest(length(text) - position('.' IN reverse(text)) + 1 - position('the' IN text) + 1, 0))"
#: name: (Column function, SQL) of ``text``; queries return doc_id, the new text's length and md5.
MODIFIERS = {
    "boilerplate": (
        modifiers.remove_boilerplate(),
        f"""CASE WHEN contains(lower(text), 'lorem ipsum') THEN ''
        WHEN len(list_filter({PARAGRAPHS}, lambda x: {POLICY})) = 0 THEN text
        WHEN len(list_filter({PARAGRAPHS}, lambda x: {POLICY})) < len({PARAGRAPHS})
         AND len({PARAGRAPHS}) - list_position(list_reverse(list_transform({PARAGRAPHS}, lambda x: {POLICY})), true) + 1
             - list_position(list_transform({PARAGRAPHS}, lambda x: {POLICY}), true) + 1 = len(list_filter({PARAGRAPHS}, lambda x: {POLICY}))
         AND (list_position(list_transform({PARAGRAPHS}, lambda x: {POLICY}), true) = 1 OR list_position(list_reverse(list_transform({PARAGRAPHS}, lambda x: {POLICY})), true) = 1)
        THEN array_to_string(list_filter({PARAGRAPHS}, lambda x: NOT ({POLICY})), chr(10) || chr(10)) ELSE text END""",
    ),
    "lines": (modifiers.remove_lines(["The.", "Der.", "La.", "Le."]), "array_to_string(list_filter(string_split(text, chr(10)), lambda s: s NOT IN ('The.', 'Der.', 'La.', 'Le.')), chr(10))"),
    "markdown": (
        modifiers.remove_markdown,
        r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\*\*([^\n]*?)\*\*', '\1', 'g'), '\*([^\n]*?)\*', '\1', 'g'), '_([^\n]*?)_', '\1', 'g'), '\[[^\n]*?\]\(([^\n]*?)\)', '\1', 'g')",
    ),
    "newlines": (modifiers.normalise_newlines, r"regexp_replace(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), '(\r\n){3,}', chr(13) || chr(10) || chr(13) || chr(10), 'g')"),
    "quotation": (
        modifiers.remove_quotation,
        f"CASE WHEN length({strip('text')}) > 2 AND starts_with(text, '\"') AND ends_with(text, '\"') AND (NOT contains({strip('text')}, chr(10)) OR NOT ends_with(string_split(text, chr(10))[1], '\"')) THEN substring(text, 2, length(text) - 2) ELSE text END",
    ),
    "slice": (modifiers.slice_text("the", "."), f"CASE WHEN position('the' IN text) = 0 OR position('.' IN text) = 0 THEN '' ELSE {strip(_BETWEEN)} END"),
    "slice_positions": (modifiers.slice_text(3, -5, strip=False), "substring(text, 4, greatest(length(text) - 8, 0))"),
    "urls": (modifiers.remove_urls, f"regexp_replace(text, '(?i)https?://[^{WS[1:]}+|www\\.[^{WS[1:]}+', '', 'g')"),
    "label": (modifiers.label_line("__label__hq"), "'__label__hq ' || replace(replace(text, chr(10), ' '), '__label__', ' ')"),
    "center_crop": (lambda t: shape.center_crop(t, 500), "substring(text, greatest(floor((length(text) - 500) / 2), 0)::BIGINT + 1, 500)"),
    "normalise": (T.normalised, f"trim(regexp_replace(lower(text), '{WS}+', ' ', 'g'))"),
}


def _modified(step):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = harness.modify(table(spark, sf_dir, "documents").select("doc_id", "text"), step)
        return docs.select("doc_id", F.length("text").alias("n"), F.md5("text").alias("md5"))

    return query


def unicode_reformatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _modified(modifiers.reformat_unicode())(spark, sf_dir)


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.split_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), "\n")


def join_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.join_documents(table(spark, sf_dir, "conversations"), "\n", segment_id_field="turn", document_id_field="conv_id")


def repack_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("length", F.length("text").cast("long"))
    return shape.join_documents(turns, "\n", segment_id_field="turn", document_id_field="conv_id", drop_segment_id_field=False, max_length=400, length_field="length")


def merged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("n", F.length("text").cast("long"))
    return shape.merge_chunks(turns, ["conv_id"], "text", None, "turn", no_content=["none"], sum_columns=["n"]).drop("turn")


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.add_id(table(spark, sf_dir, "documents").select("doc_id"), "id", "doc", order_by=["doc_id"])


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.split_by_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), lambda texts: [len(t.split()) for t in texts], 200, "\n")


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", normalise=True)


def exact_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return dedup.remove_ids(docs, dedup.exact_duplicates(docs, "doc_id"), "doc_id").select("doc_id", "n_chars")


def fuzzy_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.fuzzy_duplicates(table(spark, sf_dir, "documents"), "doc_id")


def lsh_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    signatures = dedup.minhash(table(spark, sf_dir, "documents"), "doc_id")
    return dedup.lsh_buckets(signatures)


def customer_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the graph of orders and their customers."""
    orders = table(spark, sf_dir, "orders").where("o_custkey IS NOT NULL")
    edges = orders.select(F.col("o_custkey").alias("id_x"), (F.lit(10_000_000) + F.col("o_orderkey")).alias("id_y"))
    return dedup.components(edges).select(F.col(dedup.ID).alias("id"), F.col(dedup.GROUP).alias("component"))


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cluster(table(spark, sf_dir, "embeddings"), 10, "vec_id", "embedding", max_iter=20).drop("embedding")


def _by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").alias("centroid"), F.lit(0.0).alias("cosine_dist_to_cent"))


def pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels stand for clusters, so that SQL gives the same rows."""
    return dedup.pairwise(_by_label(spark, sf_dir), "easy").select("id", "max_id", F.round("cosine_sim_score", 6).alias("cosine_sim_score"))


def semantic_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.semantic_duplicates(table(spark, sf_dir, "embeddings"), 10, 0.1, "vec_id", "embedding", max_iter=20)


def preserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harness.preserve_by_value(table(spark, sf_dir, "events").select("event_id", "value"), "value", 50, "ge")


QUERIES = {f"modify_{n}": _modified(step) for n, (step, _) in MODIFIERS.items()} | {
    "modify_unicode": unicode_reformatted,
    "split_documents": split_lines,
    "join_documents": join_turns,
    "join_documents_max_length": repack_turns,
    "merge_chunks": merged_turns,
    "add_id": numbered,
    "split_by_tokens": chunked,
    "exact_duplicates": exact_duplicates,
    "exact_deduplicated": exact_deduplicated,
    "fuzzy_duplicates": fuzzy_duplicates,
    "lsh_buckets": lsh_buckets,
    "connected_components": customer_components,
    "semantic_clusters": clustered,
    "semantic_pairwise": pairwise,
    "semantic_duplicates": semantic_duplicates,
    "preserve_by_value": preserved,
}
ORACLE_SQL = {f"modify_{n}": f"SELECT doc_id, length(m)::INTEGER AS n, md5(m) AS md5 FROM (SELECT doc_id, {sql} AS m FROM documents)" for n, (_, sql) in MODIFIERS.items()} | {
    "split_documents": "SELECT doc_id, unnest(string_split(text, chr(10))) AS text, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INTEGER AS segment_id FROM documents",
    "join_documents": "SELECT conv_id, arg_min(role, turn) AS role, string_agg(text, chr(10) ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id",
    "merge_chunks": """WITH one AS (SELECT conv_id, turn, min((role, text, length(text)::BIGINT)) AS r FROM conversations GROUP BY ALL),
parts AS (SELECT conv_id, turn, r[1] AS role, r[2] AS text, r[3] AS n FROM one WHERE r[2] NOT IN ('', chr(10), 'none'))
SELECT conv_id, arg_min(role, turn) AS role, string_agg(text, chr(10) ORDER BY turn) AS text, sum(n)::BIGINT AS n
FROM parts GROUP BY conv_id HAVING length(string_agg(text, chr(10))) <= 900000""",
    "add_id": "SELECT doc_id, 'doc_' || (row_number() OVER (ORDER BY doc_id) - 1) AS id FROM documents",
    "exact_duplicates": f"WITH h AS (SELECT doc_id, md5(trim(regexp_replace(lower(text), '{WS}+', ' ', 'g'))) AS h FROM documents) SELECT doc_id AS id FROM h QUALIFY doc_id > min(doc_id) OVER (PARTITION BY h)",
    "exact_deduplicated": "SELECT doc_id, n_chars FROM documents QUALIFY doc_id = min(doc_id) OVER (PARTITION BY md5(text))",
    "connected_components": """WITH e AS (SELECT o_custkey AS c, 10000000 + o_orderkey AS o FROM orders WHERE o_custkey IS NOT NULL)
SELECT DISTINCT c AS id, c AS component FROM e UNION SELECT o, min(c) FROM e GROUP BY o""",
    "semantic_pairwise": """WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings),
s AS (SELECT a.vec_id AS id, b.vec_id AS max_id, list_cosine_similarity(a.e, b.e) AS s, b.r AS r FROM v a JOIN v b ON a.label = b.label AND b.r < a.r)
SELECT id, max_id, round(s, 6) AS cosine_sim_score FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, r) = 1
UNION ALL SELECT vec_id, vec_id, 0.0 FROM v WHERE r = 1""",
    "preserve_by_value": "SELECT event_id, value FROM events WHERE value >= 50",
}
