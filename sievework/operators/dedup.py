"""Exact, fuzzy and semantic deduplication, and removal by id."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.plans.graph import connected_components
from sievework.plans.skew import join_about
from sievework.plans.tables import materialise

#: Hashes of n-grams that are multiplied at a time: the products stay in a core's cache.
BLOCK = 256
ID, SIGNATURE, BUCKET, GROUP = "_dedup_id", "_minhash_signature", "_bucket_id", "_duplicate_group_id"


def exact_groups(df: DataFrame, id_field: str = "id", text_field: str = "text", normalise: bool = False) -> DataFrame:
    """``(hash, keep, n)`` of each text: md5, the smallest id and the number of rows, aggregated before the shuffle."""
    text = T.normalised(F.col(text_field)) if normalise else F.col(text_field)
    return df.select(F.col(id_field).alias("id"), F.md5(text).alias("hash")).where("hash IS NOT NULL").groupBy("hash").agg(F.min("id").alias("keep"), F.count("*").alias("n"))


def exact_duplicates(df: DataFrame, id_field: str = "id", text_field: str = "text", normalise: bool = False) -> DataFrame:
    """``(id)`` of every row whose text a row with a smaller id has."""
    text = T.normalised(F.col(text_field)) if normalise else F.col(text_field)
    rows = df.select(F.col(id_field).alias("id"), F.md5(text).alias("hash"))
    many = exact_groups(df, id_field, text_field, normalise).where("n > 1").select("hash", "keep")
    return join_about(rows, many, "hash", "inner").where("id <> keep").select("id").distinct()


def remove_ids(df: DataFrame, ids: DataFrame, id_field: str = "id", duplicate_id_field: str = "id", drop_id_field: bool = False) -> DataFrame:
    """``df`` without the rows whose id is listed: an anti-join, broadcast by Spark's own threshold."""
    listed = ids.select(F.col(duplicate_id_field).alias("_gone"))
    out = df.join(listed, F.col(id_field) == F.col("_gone"), "left_anti")
    return out.drop(id_field) if drop_id_field else out


def gram_hashes(text: str, n: int) -> np.ndarray:
    """64-bit hashes of a text's distinct character n-grams, all at once: a polynomial in their code points, mixed. A
    shorter text is one n-gram."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = min(n, max(1, len(points)))
    h = np.zeros(max(1, len(points) - n + 1), np.uint64)
    for k in range(min(n, len(points))):
        h = h * _BASE + points[k : k + len(h)]
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return np.unique(h ^ (h >> np.uint64(29)))


_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def minhash(df: DataFrame, id_field: str = "id", text_field: str = "text", char_ngrams: int = 24, num_hashes: int = 260, seed: int = 42, normalise: bool = False, use_64bit: bool = False) -> DataFrame:
    """``(_dedup_id, _minhash_signature)``: for each of ``num_hashes`` seeded pairs (a, b), a odd, the least of
    (a h + b) mod 2^64 over the hashes h of a text's character n-grams; its upper 32 bits, or all 64 (signed)."""
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(0, 1 << 64, num_hashes, np.uint64) for _ in range(2))
    a |= np.uint64(1)
    text = T.normalised(F.col(text_field)) if normalise else F.col(text_field)

    def signature(value: str, products: np.ndarray) -> np.ndarray:
        h, out = gram_hashes(value, char_ngrams), np.full(num_hashes, ~np.uint64(0), np.uint64)
        for i in range(0, len(h), len(products)):  # a block of products at a time, in memory that stays in the cache
            block = products[: len(h) - i]
            np.multiply(h[i : i + len(block), None], a, out=block)
            np.add(block, b, out=block)
            np.minimum(out, block.min(0), out=out)
        return out.view(np.int64) if use_64bit else (out >> np.uint64(32)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.empty((BLOCK, num_hashes), np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [signature(t.as_py(), products) for t in part.column(1)]
                flat = pa.array(np.concatenate(rows))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * num_hashes), flat)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[ID, SIGNATURE])

    from pyspark.sql.types import ArrayType, LongType, StructField, StructType

    rows = df.select(F.col(id_field).alias(ID), text.alias("text")).where("text IS NOT NULL")
    return rows.mapInArrow(run, StructType([StructField(ID, rows.schema[ID].dataType), StructField(SIGNATURE, ArrayType(LongType()))]))


def band_keys(signatures: DataFrame, num_bands: int = 20, per_band: int = 13) -> DataFrame:
    """``(_bucket_id, _dedup_id)``: a row for each band of a signature, its bucket named by band and md5 of the band."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(num_bands - 1)), lambda i: F.concat(F.lit("b"), i.cast("string"), F.lit("_"), F.md5(F.array_join(F.slice(SIGNATURE, i * per_band + 1, F.lit(per_band)).cast("array<string>"), ","))))
    return signatures.select(F.explode(bands).alias(BUCKET), ID)


def lsh_buckets(signatures: DataFrame, num_bands: int = 20, per_band: int = 13) -> DataFrame:
    """``(_bucket_id, _dedup_id array)``: sorted ids of each bucket that two or more have."""
    return band_keys(signatures, num_bands, per_band).groupBy(BUCKET).agg(F.sort_array(F.collect_set(ID)).alias(ID)).where(F.size(ID) > 1)


def bucket_edges(buckets: DataFrame) -> DataFrame:
    """``(id_x, id_y)``: chains of a bucket's neighbouring ids, n - 1 edges for n ids."""
    pairs = F.zip_with(F.slice(ID, F.lit(1), F.size(ID) - 1), F.slice(ID, F.lit(2), F.size(ID) - 1), lambda x, y: F.struct(x.alias("id_x"), y.alias("id_y")))
    return buckets.where(F.size(ID) > 1).select(F.explode(pairs).alias("e")).select("e.id_x", "e.id_y").distinct()


def star_edges(keys: DataFrame) -> DataFrame:
    """``(a, b)``: each id of a bucket and the bucket's smallest. The same components as chains, without gathering a
    bucket's ids in one row: minima are partially aggregated."""
    low = keys.groupBy(BUCKET).agg(F.min(ID).alias("b"), F.count("*").alias("n")).where("n > 1").select(BUCKET, "b")
    return join_about(keys, low, BUCKET, "inner").select(F.col(ID).alias("a"), "b").where("a <> b").distinct()


def components(edges: DataFrame, left: str = "id_x", right: str = "id_y") -> DataFrame:
    """``(_dedup_id, _duplicate_group_id)`` of every id that has an edge; a group is named by its smallest id."""
    found = connected_components(edges.select(F.col(left).alias("a"), F.col(right).alias("b")))
    return found.select(F.col("node").alias(ID), F.col("component").alias(GROUP)).unionByName(found.select(F.col("component").alias(ID), F.col("component").alias(GROUP)).distinct())


def group_duplicates(groups: DataFrame, id_field: str = ID, group_field: str = GROUP) -> DataFrame:
    """``(id)`` of all but the smallest id of each group."""
    low = groups.groupBy(group_field).agg(F.min(id_field).alias("_keep"))
    return join_about(groups, low, group_field, "inner").where(F.col(id_field) != F.col("_keep")).select(F.col(id_field).alias("id")).distinct()


@dataclass(frozen=True)
class FuzzyOptions:
    char_ngrams: int = 24
    num_bands: int = 20
    per_band: int = 13
    seed: int = 42
    use_64bit: bool = False
    normalise: bool = False


def fuzzy_duplicates(df: DataFrame, id_field: str = "id", text_field: str = "text", options: FuzzyOptions | None = None) -> DataFrame:
    """``(id)`` of all but one document of each group linked by minhash buckets."""
    o = options or FuzzyOptions()
    signatures = minhash(df, id_field, text_field, o.char_ngrams, o.num_bands * o.per_band, o.seed, o.normalise, o.use_64bit)
    keys = materialise(band_keys(signatures, o.num_bands, o.per_band), "bands")
    return group_duplicates(components(star_edges(keys), "a", "b"))


def cluster(df: DataFrame, n_clusters: int, id_field: str = "id", embedding_field: str = "embeddings", max_iter: int = 300, tol: float = 1e-4, seed: int = 42, fit_fraction: float = 1.0) -> DataFrame:
    """``(id, embedding, centroid, l2_dist_to_cent, cosine_dist_to_cent)``: k-means over normalised vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    size = F.sqrt(F.aggregate(embedding_field, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = df.withColumn("_size", size).where("_size > 0").select(F.col(id_field).alias("id"), F.transform(embedding_field, lambda x: x.cast("double") / F.col("_size")).alias("embedding"))
    rows = materialise(rows.withColumn("features", array_to_vector("embedding")), "unit")
    sample = rows if fit_fraction >= 1 else rows.sample(fit_fraction, seed)
    model = KMeans(k=n_clusters, maxIter=max_iter, tol=tol, seed=seed).fit(sample)
    centres = [[float(x) for x in c] for c in model.clusterCenters()]
    at = F.array(*[F.array(*map(F.lit, c)) for c in centres])
    out = model.transform(rows).withColumnRenamed("prediction", "centroid").withColumn("_c", F.element_at(at, F.col("centroid") + 1))
    dot = F.aggregate(F.zip_with("embedding", "_c", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    square = F.aggregate(F.zip_with("embedding", "_c", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate("_c", F.lit(0.0), lambda s, x: s + x * x))
    return out.select("id", "embedding", "centroid", F.sqrt(square).alias("l2_dist_to_cent"), (1 - F.try_divide(dot, norm)).alias("cosine_dist_to_cent"))


RANKS = {"hard": lambda m: [F.desc(m), F.desc("id")], "easy": lambda m: [F.asc(m), F.asc("id")], "random": lambda m: [F.xxhash64("id"), F.asc("id")]}


def pairwise(clustered: DataFrame, which_to_keep: str = "hard", metric: str = "cosine", centroid: str = "centroid", block: int = 2048, seed: int = 42) -> DataFrame:
    """``(id, max_id, cosine_sim_score)``: for each vector the most similar among those ranked before it in its cluster;
    the first has itself and 0. Ties go to the earlier.

    Rows are ranked in Spark and cut into blocks by rank; each task multiplies one block with one of the blocks before
    it, and the best are combined after, so no task holds a cluster.
    """
    if which_to_keep not in RANKS:
        raise ValueError(f"which_to_keep {which_to_keep!r} is none of {sorted(RANKS)}")
    measure = {"cosine": "cosine_dist_to_cent", "l2": "l2_dist_to_cent"}[metric]
    order = RANKS[which_to_keep](measure) if which_to_keep != "random" else [F.xxhash64(F.lit(seed), "id"), F.asc("id")]
    ranked = clustered.select("id", "embedding", F.col(centroid).alias("c"), F.row_number().over(Window.partitionBy(centroid).orderBy(*order)).alias("rank")).withColumn("b", F.floor((F.col("rank") - 1) / block).cast("int"))
    ranked = materialise(ranked, "ranked")
    last = ranked.groupBy("c").agg(F.max("b").alias("last"))
    mine = ranked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("b")))).withColumn("side", F.lit(1))
    theirs = ranked.join(last, "c").withColumn("row", F.explode(F.sequence(F.col("b"), F.col("last"))))
    both = mine.select("c", F.col("b").alias("row"), F.col("b").alias("own"), F.col("other").alias("col"), "side", "id", "rank", "embedding").unionByName(theirs.select("c", "row", F.col("b").alias("own"), F.col("b").alias("col"), F.lit(0).alias("side"), "id", "rank", "embedding"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        x, y = frame[frame.side == 1].sort_values("rank"), frame[frame.side == 0].sort_values("rank")
        if x.empty or y.empty:
            return pd.DataFrame({"id": [], "best": [], "rank": [], "score": []})
        p, q = (np.stack(f.embedding.to_numpy()).astype(float) for f in (x, y))
        p, q = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) for m in (p, q))
        score = p @ q.T
        score[y["rank"].to_numpy()[None] >= x["rank"].to_numpy()[:, None]] = -np.inf
        at = score.argmax(1)
        got = score[np.arange(len(x)), at]
        return pd.DataFrame({"id": x.id.to_numpy(), "best": y.id.to_numpy()[at], "rank": y["rank"].to_numpy()[at], "score": got})[got > -np.inf]

    kind = ranked.schema["id"].dataType.simpleString()
    found = both.groupBy("c", "row", "col").applyInPandas(run, f"id {kind}, best {kind}, rank long, score double")
    top = found.groupBy("id").agg(F.max(F.struct(F.col("score"), (-F.col("rank")).alias("r"), F.col("best"))).alias("t"))
    first = ranked.where("rank = 1").select("id", F.col("id").alias("max_id"), F.lit(0.0).alias("cosine_sim_score"))
    return top.select("id", F.col("t.best").alias("max_id"), F.col("t.score").alias("cosine_sim_score")).unionByName(first)


def similar_ids(scores: DataFrame, eps: float) -> DataFrame:
    """``(id)`` whose similarity is at least 1 - eps."""
    return scores.where(F.col("cosine_sim_score") >= 1 - eps).select("id")


def semantic_duplicates(df: DataFrame, n_clusters: int, eps: float, id_field: str = "id", embedding_field: str = "embeddings", which_to_keep: str = "hard", **options) -> DataFrame:
    """``(id)`` of vectors within ``eps`` of one ranked before them in their cluster."""
    return similar_ids(pairwise(cluster(df, n_clusters, id_field, embedding_field, **options), which_to_keep), eps)


def id_ranges(df: DataFrame, file_field: str, order: list[str], known: DataFrame | None = None, start: int = 0) -> DataFrame:
    """``(file, part, first, rows)``: where the ids of each file's rows begin, files in order of their names. Files that
    ``known``, such a table, has keep their ranges; others come after them. Kept as a table, it gives the same ids again.

    A file's rows are dealt to ID_PARTS parts by a hash of ``order``, columns that tell its rows apart, so none is
    numbered in one task.
    """
    counted = df.groupBy(F.col(file_field).alias("file"), _id_part(order).alias("part")).agg(F.count("*").alias("rows"))
    if known is None:
        at = F.lit(start).cast("long")
    else:
        counted = counted.join(known, "file", "left_anti")
        at = F.lit(max(start, known.agg(F.max(F.col("first") + F.col("rows"))).first()[0] or 0))
    # a row for each part of a file: few enough for one task
    upto = F.sum("rows").over(Window.orderBy("file", "part").rowsBetween(Window.unboundedPreceding, 0))
    fresh = counted.select("file", "part", (at + upto - F.col("rows")).alias("first"), "rows")
    return fresh if known is None else known.select("file", "part", "first", "rows").unionByName(fresh)


def add_range_ids(df: DataFrame, ranges: DataFrame, file_field: str, order: list[str], id_field: str = ID) -> DataFrame:
    """``df`` with ids by :func:`id_ranges`: the same for the same rows in every run."""
    about = ranges.select(F.col("file").alias("_file"), F.col("part").alias("_part"), F.col("first").alias("_first"))
    rows = df.withColumn("_part", _id_part(order))
    rank = F.row_number().over(Window.partitionBy(file_field, "_part").orderBy(*order)) - 1
    met = rows.withColumn("_rank", rank).alias("d").join(about.alias("r"), (F.col(f"d.{file_field}") == F.col("r._file")) & (F.col("d._part") == F.col("r._part")))
    return met.select(*[F.col(f"d.{c}") for c in df.columns if c != id_field], (F.col("r._first") + F.col("d._rank")).alias(id_field))


ID_PARTS = 64


def _id_part(order: list[str]):
    return F.pmod(F.xxhash64(*order), F.lit(ID_PARTS)).cast("int")
