"""Exact top-k inner products by a pivot-distance index.

Vectors become integers, floor(scale * x). With a further coordinate sqrt(M - |x|^2), M the largest squared length,
the largest inner products of a query are its nearest points: |q - x|^2 = |q|^2 + M - 2 <q, x>. Points are keyed by their
nearest pivot and their distance from it, and lie sorted by it in blocks. A query first searches the block of its
nearest pivot whose annulus is nearest, for a bound on its k-th distance; then every block whose annulus
[dmin, dmax] may hold a nearer point by the triangle inequality, | d(q, p) - d(x, p) | <= d(q, x); in a block the annulus
is expanded from the query's own distance outward until the inequality stops it. Scores are exact integers.

Edge cases: vectors that are null or have a null or non-finite component take no part; vectors of other lengths than
the query's aren't its candidates. Rows with a null id are neither queries nor candidates. Each row is a query and a
candidate of its own, also where ids repeat: a row's candidates are all rows but itself, and a repeated query id has as
many answers as rows. Scores beyond 64 bits are held to the largest or smallest there is. Fewer candidates than k give
fewer rows. Columns other than id and vector are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm._runtime import materialise, reach, tidy

SCALE, K = 256, 5
#: Points of a block, pivots of a vector length, and the points pivots are chosen from.
BLOCK, PIVOTS, SAMPLE = 4096, 64, 5000
#: Components beyond this make a point wild: it has no pivot and is compared with all, so that no distance overflows.
WILD = float(1 << 40)
#: Columns that name a block, those of an answer, and those of a query's ray to a pivot.
PLACE, ANSWER, RAY = ["dim", "pivot", "annulus", "part"], ("query", "query_id", "vec_id", "score"), "row long, dim int, pivot int, away double, wide double"
#: The least score there is, and queries of a block that one task may get.
LEAST, LOT = -(2**63), 1 << 15
#: Rows up to which the list of blocks (some 60 bytes each) is broadcast; beyond it both sides are shuffled.
MOST_SENT = 200_000
#: Share by which distances are widened before they rule a point out: rounding never loses one.
SLACK = 1e-9


def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.coalesce(fine, F.lit(False)))
    # kept as doubles: whole numbers of any size that floor gives
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "x")  # written at once, so it stays
    return rows.select("row", "vec_id", F.transform("x", lambda v: F.rint(v * scale - F.lit(0.0)) - (F.rint(v * scale) > v * scale).cast("double")).alias("x"), F.size("x").alias("dim")).withColumn("norm", F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim) if dim else np.zeros((len(column), 0))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products as int64: doubles where no sum reaches 2**53, else Python's integers, held to 64 bits."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if bound < 2**53:
        return (q @ x.T).astype(np.int64)
    exact = np.array([[int(v) for v in r] for r in q], object).reshape(q.shape) @ np.array([[int(v) for v in r] for r in x], object).reshape(x.shape).T
    return np.array(np.clip(exact, -(2**63), 2**63 - 1), np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(ids) > 4 * k:
        low = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= low)
    else:
        at = np.arange(len(ids))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _keyed(rows: DataFrame, pivots: dict[int, tuple[np.ndarray, float]]) -> DataFrame:
    """Points with their nearest pivot and their distance from it; queries' own distances leave the further coordinate 0."""
    sent = rows.sparkSession.sparkContext.broadcast(pivots)  # PIVOTS points for each vector length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy(zero_copy_only=False)
            pivot, dist = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                centre, m = sent.value[d]
                x = matrix(batch.column(2).take(pa.array(at)), d)
                wild = np.abs(x).max(1, initial=0) > WILD
                pivot[at[wild]] = -1
                at, x = at[~wild], x[~wild]
                if not len(at):
                    continue
                lifted = np.append(x, np.sqrt(np.maximum(m - (x * x).sum(1), 0))[:, None], 1)
                far = distances(lifted, centre)
                pivot[at] = far.argmin(1)
                dist[at] = far.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(dist)], names=[*batch.schema.names, "pivot", "dist"])

    return rows.mapInArrow(tidy(run), "row long, vec_id long, x array<double>, dim int, norm double, pivot int, dist double")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0))


def _search(k: int, pivots: dict, bounded: bool):
    """Group function over one block of points (side 0) and query rows (side 1, with ``bound``, the k-th score so far)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        dim, pivot = table.column("dim")[0].as_py(), table.column("pivot")[0].as_py()
        ids, own, dist, bound = (table.column(c).to_numpy() for c in ("vec_id", "row", "dist", "bound"))
        x = matrix(pa.concat_arrays(table.column("x").chunks), dim)
        p, q = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(p) or not len(q):
            return pa.table({c: pa.array([], pa.int64()) for c in ANSWER})
        p = p[np.argsort(dist[p], kind="stable")]
        centre, m = pivots[dim]
        wild = (np.abs(x[q]).max(1, initial=0) > WILD) | (pivot < 0)
        tame = np.where(wild[:, None], 0.0, x[q])
        away = distances(np.append(tame, np.zeros((len(q), 1)), 1), centre[max(pivot, 0)][None])[:, 0]
        lengths, floor = (tame * tame).sum(1), bound[q].astype(float)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        near = dist[p]
        for a in range(0, len(q), 64):
            rows = slice(a, a + 64)
            # annulus of each query: points whose distance from the pivot is within the radius of its own
            radius = np.sqrt(np.maximum(lengths[rows] + m - 2 * floor[rows], 0)) if bounded else np.full(len(q[rows]), np.inf)
            radius[wild[rows]] = np.inf
            wide = radius * (1 + SLACK) + SLACK * (away[rows] + np.sqrt(m) + 1) * 10
            lo, hi = np.searchsorted(near, away[rows] - wide), np.searchsorted(near, away[rows] + wide, "right")
            if not (hi > lo).any():
                continue
            first, last = int(lo[hi > lo].min()), int(hi[hi > lo].max())
            scores = products(x[q[rows]], x[p[first:last]])
            cand, others = ids[p[first:last]], own[p[first:last]]
            for i in range(len(scores)):
                s = slice(int(lo[i]) - first, int(hi[i]) - first) if hi[i] > lo[i] else slice(0, 0)
                c, v = cand[s], scores[i, s]
                ok = (others[s] != own[q[a + i]]) & (v >= bound[q[a + i]])
                c, v = c[ok], v[ok]
                at = best(c, v, k)
                out.append((np.full(len(at), own[q[a + i]]), np.full(len(at), ids[q[a + i]]), c[at], v[at]))
        columns = list(zip(*out, strict=True)) or [[np.zeros(0)]] * 4
        return pa.table({c: pa.array(np.concatenate(v).astype(np.int64)) for c, v in zip(ANSWER, columns, strict=True)})

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``is_query`` (a Column over ``vec_id``) holds, the k
    highest integer inner products with the others, ties to the smaller id."""
    spark = vectors.sparkSession
    reach(spark)
    rows = materialise(quantised(vectors, scale, id_col, vector_col), "vectors")
    pivots = {}
    tame = ~F.exists("x", lambda v: F.abs(v) > WILD)
    for d, n, m in rows.groupBy("dim").agg(F.count_if(tame), F.coalesce(F.max(F.when(tame, F.col("norm"))), F.lit(0.0))).collect():
        part = rows.where((F.col("dim") == d) & tame)
        part = part if n <= SAMPLE else part.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int((1 << 20) * SAMPLE / n))
        x = matrix(part.orderBy(F.xxhash64("vec_id"), "vec_id", "x").select("x").toArrow().column(0).combine_chunks(), d)
        x = np.append(x, np.sqrt(np.maximum(m - (x * x).sum(1), 0))[:, None], 1) if len(x) else np.zeros((1, d + 1))
        chosen, far = [0], distances(x, x[:1])[:, 0]
        while len(chosen) < min(PIVOTS, len(x)):  # farthest first
            chosen.append(int(far.argmax()))
            far = np.minimum(far, distances(x, x[chosen[-1:]])[:, 0])
        pivots[d] = (x[chosen], float(m))
    keyed = materialise(_keyed(rows, pivots), "keyed")
    blocked = _blocked(keyed)
    # a row for each block, of thousands of points: what may be in it
    blocks = materialise(blocked.groupBy(*PLACE).agg(F.min("dist").alias("low"), F.max("dist").alias("high"), F.count("*").alias("n")), "block_list")
    queries = keyed.where(is_query)
    n_queries = queries.count()
    lots = max(1, -(-n_queries // LOT))
    points = blocked.select(*PLACE, F.lit(0).alias("side"), "row", "vec_id", "x", "dist", F.lit(LEAST).cast("long").alias("bound"))

    def found(asked: DataFrame, bounded: bool) -> DataFrame:
        """Best rows of each query in the blocks that it is dealt to. Queries of a block are dealt to lots; the points of
        a block go to those lots alone that have queries for it."""
        asked = asked.withColumn("lot", F.pmod(F.xxhash64("row"), F.lit(lots)).cast("int"))
        wanted = asked.select(*PLACE, "lot").distinct()
        asked = asked.select(*PLACE, F.lit(1).alias("side"), "row", "vec_id", "x", F.lit(0.0).alias("dist"), "bound", "lot")
        spread = points.join(wanted, PLACE).select(asked.columns)
        return spread.unionByName(asked).groupBy(*PLACE, "lot").applyInArrow(_search(k, pivots, bounded), ", ".join(f"{c} long" for c in ANSWER))

    start = queries.select("row", "vec_id", "x", "dim", F.lit(LEAST).cast("long").alias("bound"))
    rays = materialise(start.select("row", "x", "dim", "bound").mapInArrow(tidy(_rays(pivots)), RAY), "rays")
    # first the nearest block of those that hold enough
    low = F.greatest(F.col("low") - F.col("away"), F.col("away") - F.col("high"), F.lit(0.0)) + F.col("away") * 1e-6
    listed = F.broadcast(blocks) if blocks.count() <= MOST_SENT else blocks
    near = rays.join(listed.where(F.col("n") > k), ["dim", "pivot"]).groupBy("row").agg(F.min(F.struct(low.alias("low"), *[c for c in PLACE])).alias("b")).select("row", "b.*").drop("low")
    first = found(start.drop("dim").join(near, "row"), False)
    kth = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") >= k).select(F.col("query").alias("row"), F.col("s").alias("bound"))
    bounded = materialise(start.drop("bound").join(kth, "row", "left").withColumn("bound", F.coalesce("bound", F.lit(LEAST).cast("long"))), "bounds")
    # then every block whose annulus meets that of a query
    rays = bounded.select("row", "x", "dim", "bound").mapInArrow(tidy(_rays(pivots)), RAY)
    met = rays.join(listed, ["dim", "pivot"]).where((F.col("low") <= F.col("away") + F.col("wide")) & (F.col("high") >= F.col("away") - F.col("wide")))
    got = found(bounded.drop("dim").join(met.select("row", *PLACE), "row"), True)
    ranked = got.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _blocked(keyed: DataFrame) -> DataFrame:
    """Points with their block: the annuli of a pivot are cut at quantiles of the distance from it; beyond 64 annuli, and
    for distances that many points share, a hash cuts on."""
    spark = keyed.sparkSession
    quantiles = keyed.groupBy("dim", "pivot").agg(F.count("*").alias("n"), F.percentile_approx("dist", [i / 64 for i in range(65)], 1000).alias("at")).collect()  # a row a pivot
    cuts = []
    for r in quantiles:
        n = max(1, -(-r.n // BLOCK))
        cuts.append((r.dim, r.pivot, sorted({float(r.at[min(64, round(64 * i / n))]) for i in range(1, n)}) if n > 1 else []))
    cut_table = spark.createDataFrame(cuts, "dim int, pivot int, cuts array<double>")
    annulus = F.size(F.filter("cuts", lambda c: c <= F.col("dist")))
    placed = keyed.join(F.broadcast(cut_table), ["dim", "pivot"]).withColumn("annulus", annulus).drop("cuts")
    parts = placed.groupBy("dim", "pivot", "annulus").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))  # 65 rows a pivot at most
    placed = placed.join(F.broadcast(parts), ["dim", "pivot", "annulus"])
    return materialise(placed.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts"), "blocks")


def _rays(pivots: dict):
    """A query's distance from each pivot of its length (and -1, whose points have none), and how far from the pivot's
    circle through it a point of the bound's score may lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == d)))
                x, bound = matrix(part.column(1), d), part.column(3).to_numpy(zero_copy_only=False).astype(float)
                centre, m = pivots[d]
                wild = np.abs(x).max(1, initial=0) > WILD
                tame = np.where(wild[:, None], 0.0, x)
                away = distances(np.append(tame, np.zeros((len(x), 1)), 1), centre)
                radius = np.sqrt(np.maximum((tame * tame).sum(1) + m - 2 * np.maximum(bound, -1e300), 0))
                wide = (radius * (1 + SLACK))[:, None] + SLACK * (away + np.sqrt(m) + 1) * 10
                wide[wild] = np.inf
                # points without a pivot are met by all
                away, wide = np.append(away, np.zeros((len(x), 1)), 1), np.append(wide, np.full((len(x), 1), np.inf), 1)
                n = away.shape[1]
                pivot = np.tile(np.append(np.arange(n - 1), -1).astype(np.int32), len(x))
                row = np.repeat(part.column(0).to_numpy(zero_copy_only=False), n)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.full(len(row), d, np.int32)), pa.array(pivot), pa.array(away.ravel()), pa.array(wide.ravel())], names=["row", "dim", "pivot", "away", "wide"])

    return run
