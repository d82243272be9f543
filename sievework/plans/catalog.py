"""Registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.plans import filter_queries, other_queries, row_queries, shape_queries

_PARTS = (filter_queries, shape_queries, other_queries, row_queries)
QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
ORACLE_SQL = {k: v for part in _PARTS for k, v in part.ORACLE_SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter chain."""
    return filter_queries.chain(spark, sf_dir)
