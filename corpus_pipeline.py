"""A corpus pipeline over ``documents``: toxicity, near-duplicates, secrets, source mix, packing.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import mixing, packing, secrets, shingle_join, toxicity
from sievework.llm._encoder import public_tokenizer
from sievework.llm._runtime import forget, scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, learnt from the rows of ``labels`` that aren't held out, rejects."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: five-word shingles, a Jaccard similarity of 0.8 or more. SimHash
    fingerprints find most links; an exact join of shingle sets finds the rest."""
    return shingle_join.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mark; all documents stay."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, cut where it takes a part of it."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: None: SQL has neither the classifier nor the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is a table; what a stage needs on the way, and the result before it, is deleted after it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), f"pipeline_{name}")
        if before is not None:
            forget(before)
        before = docs
    return docs
