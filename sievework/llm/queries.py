"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import embed_dedup, licenses, mixing, packing, secrets, secrets_sql, simhash, token_files, topk, toxicity, warc
from sievework.llm._encoder import public_tokenizer
from sievework.llm._runtime import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"), F.col("toxic").alias("toxic_by_lang"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json")))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    many = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", many("assign"), many("access"), many("hex"), F.sha2(secrets.written("base"), 256).alias("base_sha256"), secrets.written("found").alias("spans"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_embedding_dedup, op3_mixing, op4_packing, op5_topk, op6_licenses, op7_token_files, op8_secrets, op9_warc, op10_simhash)}

ORACLE_SQL = {
    "op2_embedding_dedup": """
WITH RECURSIVE raw AS (SELECT vec_id, embedding, embedding::DOUBLE[] AS d FROM embeddings),
usable AS (
    SELECT vec_id, d, sqrt(list_sum(list_transform(d, lambda x: x * x))) AS norm FROM raw
    WHERE vec_id IS NOT NULL AND len(d) > 0 AND len(list_filter(d, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(d, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.d) = len(b.d) AND list_dot_product(a.d, b.d) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(m.n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(l.b, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(l.b, v.vec_id) AS kept
FROM raw v LEFT JOIN low l ON l.a = v.vec_id LEFT JOIN many m ON m.a = v.vec_id""",
    "op5_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
d AS (
    SELECT page_id, octet_length(encode(h)) AS n, max(page_id) OVER (PARTITION BY x) AS top,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(x, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31), 1)), '') AS payload_digest
    FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM d""",
    "op8_secrets": secrets_sql.oracle(),
}
