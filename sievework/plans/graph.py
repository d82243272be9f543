"""Connected components of an undirected graph."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.plans.skew import join_about
from sievework.plans.tables import forget, materialise

#: Edges up to which one task joins them (some 16 MB of ids).
SMALL = 500_000


def local_roots(n: int, a, b, label=None):
    """Smallest-index labels of 0..n-1 after joining a[i] with b[i]; ``label`` continues an earlier call."""
    import numpy as np

    label = np.arange(n) if label is None else label
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _in_one_task(edges: DataFrame) -> DataFrame:
    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        kind = table.schema.field(0).type
        a, b = (table.column(i).to_numpy() for i in range(2))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = local_roots(len(nodes), at[: len(a)], at[len(a) :])
        other = np.flatnonzero(label != np.arange(len(nodes)))
        for i in range(0, len(other), 10_000):
            part = other[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[part], kind), pa.array(nodes[label[part]], kind)], names=["node", "component"])

    kind = edges.schema["u"].dataType.simpleString()
    return edges.select("u", "v").coalesce(1).mapInArrow(run, f"node {kind}, component {kind}")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node from which a smaller one is reachable; component is the smallest.

    ``edges(a, b)`` of one orderable type, nulls and loops ignored. Up to SMALL edges are joined by one task; more by
    alternating large-star and small-star steps: each a minimum, aggregated before the shuffle, and a join that deals
    the edges of a hub to many tasks. Lineage is cut by a table in the shared folder each round.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialise(e, "edges")
    if e.count() <= SMALL:
        return _in_one_task(e)
    state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = join_about(both.where("v > u"), low, "u", "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_about(large, low, "u", "inner").select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        new = materialise(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        forget(e)
        e, done, state = new, now == state, now
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
