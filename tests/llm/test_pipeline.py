"""The registered queries and the pipeline."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sievework.llm import queries, secrets, toxicity

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DIR)
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(str([r[c] for c in sorted(columns)]) for r in df.collect()) == sorted(str([r[columns.index(c)] for c in sorted(columns)]) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_has_a_row_for_each_input(spark, name):
    table = "pages" if name.startswith("op9") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    ids = {r[0] for r in spark.read.parquet(f"{DIR}/{table}.parquet").select(key).collect()}
    rows = queries.QUERIES[name](spark, DIR).collect()
    assert {r[key] for r in rows} == ids


def test_stages_keep_their_word(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]
    clean = stages["toxicity"](spark, docs, DIR)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in scored.where("toxic = 0").collect())
    one = stages["near_duplicates"](spark, docs, DIR)
    texts = [r.text for r in one.collect()]
    assert len(texts) == len(set(texts)) and {r.text for r in docs.collect()} >= set(texts)
    planted = docs.withColumn("text", F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit(" api_key=Zx81Qw07Lk29Vb53 x"))).otherwise(F.col("text")))
    found = {r.doc_id for r in secrets.scan(planted.select("doc_id", "text")).where(F.size("found") > 0).select("doc_id").collect()}
    before, hidden = ({r.doc_id: r.text for r in d.collect()} for d in (planted, stages["secrets"](spark, planted, DIR)))
    assert {i for i in before if i % 10 == 0} <= found == {i for i in hidden if hidden[i] != before[i]}
    assert all("[SECRET]" in hidden[i] and "Zx81Qw07Lk29Vb53" not in hidden[i] for i in found)
    for name in ("toxicity", "near_duplicates", "secrets", "mixing"):
        assert stages[name](spark, docs, DIR).schema == docs.schema
        assert stages[name](spark, docs.limit(0), DIR).count() == 0
    packed = stages["packing"](spark, docs, DIR)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_run(spark):
    assert corpus_pipeline.run(spark, DIR).count() > 0
