"""Joins that a hot key doesn't bring into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.plans.tables import materialise

#: Rows from which a key counts as hot, and the tasks that its rows are dealt to.
MANY, PARTS = 2_000, 32


def join_about(rows: DataFrame, about: DataFrame, key: str, how: str = "left", counts: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``about``, a table of at most one row for each ``key``; ``how`` is left or inner.

    Keys with more than MANY rows are found first, from ``counts(key, count)`` or else from counts that are aggregated
    before the shuffle. Their rows are dealt to PARTS tasks by a hash of all their columns, and their row of ``about`` goes to each of those.
    """
    counts = rows.groupBy(key).count() if counts is None else counts
    hot = materialise(counts.where(F.col("count") > MANY).where(F.col(key).isNotNull()).select(key), "hot")
    if hot.isEmpty():
        return rows.join(about, key, how)
    # count(rows) / MANY keys at most: Spark broadcasts them where their size allows it
    own = F.when(F.col("_hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(PARTS)).cast("int")).otherwise(F.lit(0))
    dealt = rows.join(hot.withColumn("_hot", F.lit(True)), key, "left").withColumn("_part", own).drop("_hot")
    every = about.join(hot, key, "left_semi").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return dealt.join(every.unionByName(about.join(hot, key, "left_anti").withColumn("_part", F.lit(0))), [key, "_part"], how).drop("_part")
