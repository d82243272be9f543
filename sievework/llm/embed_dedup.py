"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells.

Equal vectors are one class from the start. Centroids are fitted on a bounded sample of classes; every class is
indexed in its nearest cell and probes each cell whose bisecting hyperplane with its own lies within ``margin`` (as a
sine). ``margin = sqrt(1 - threshold**2)`` is the exact bound: a linked pair can then not be lost, but in many
dimensions it probes nearly every cell. The default is smaller; the README has its recall against brute force.
Cells are cut into blocks of bounded size, and a task multiplies one block of indexed rows with one of probing rows.

Edge cases: null, zero and empty vectors, and those with a null or non-finite component, link with nothing. So do
vectors of other lengths with each other. Rows with the same id are one vertex, but each counts as a row; rows with
a null id link with nothing, have a null component and are kept. An empty table gives an empty result. Columns other
than id and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm._runtime import connected_components, join_about, local_roots, materialise, reach, tidy

THRESHOLD, MARGIN = 0.9, 0.12
#: Classes that a cell should have, the most cells, and the classes that centroids are fitted on.
CELL, MOST_CELLS, SAMPLE = 128, 4096, 20_000
#: Rows of a block of indexed and of probing classes, and rows that are compared with all centres at once.
INDEX_BLOCK, PROBE_BLOCK, ASSIGN = 4096, 8192, 512


def usable(column: str):
    """True for vectors that have a direction."""
    x = F.col(column)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(x) > 0) & fine & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists are of one length."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), np.finfo(float).tiny)  # so that squares neither vanish nor overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means: unit centroids, assignment by largest cosine; an empty cell keeps its centroid."""
    rng = np.random.default_rng(seed)
    centres = sample[np.sort(rng.permutation(len(sample))[:cells])].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(sample[i : i + 4096] @ centres.T).argmax(1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


def _assign(classes: DataFrame, centres: dict[int, np.ndarray], margin: float) -> DataFrame:
    """Each class with its cell, the cells it probes and its vector."""
    sent = classes.sparkSession.sparkContext.broadcast(centres)  # at most MOST_CELLS vectors of a length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = dict(zip(sent.value, np.cumsum([0, *map(len, sent.value.values())]).tolist(), strict=False))
        reach_of: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(4).to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                c = sent.value[d]
                if d not in reach_of:  # from each cell, how far a centre may lie behind the nearest to be probed
                    reach_of[d] = (margin * np.sqrt(np.maximum(2 - 2 * c @ c.T, 0))).astype(np.float32)
                mine = np.flatnonzero(dims == d)
                for at in range(0, len(mine), ASSIGN):
                    part = batch.take(pa.array(mine[at : at + ASSIGN]))
                    cos = unit(matrix(part.column(3))) @ c.T
                    row = np.arange(len(cos))
                    home = cos.argmax(1)
                    near = cos[row, home][:, None] - cos <= reach_of[d][home]
                    near[row, home] = True
                    cell = np.nonzero(near)[1]
                    probes = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(near.sum(1))]).astype(np.int32)), pa.array((cell + first[d]).astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array((home + first[d]).astype(np.int32)), probes, part.column(3)], names=["key", "node", "copies", "cell", "probes", "vec"])

    kind = classes.schema["vec"].dataType.simpleString()
    return classes.select("key", "node", "copies", "vec", "dim").mapInArrow(tidy(run), f"key long, node long, copies long, cell int, probes array<int>, vec {kind}")


def _products(threshold: float):
    """Per task: counts of linked rows for each class, and a spanning forest of the links."""

    def block(rows: dict[str, np.ndarray], probes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        side = rows["side"]
        ix, pr = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        n = len(side)
        count, label = np.zeros(n, np.int64), np.arange(n)
        _, at, back = np.unique(rows["node"], return_index=True, return_inverse=True)
        label = np.minimum(label, at[back])
        if len(ix) and len(pr):
            cell = rows["at"][0]
            # does an indexed row probe the probing row's cell too? then it counts this link there
            home = rows["cell"]
            other = np.unique(home[pr])
            spot = np.searchsorted(other, home)
            back_probe = np.zeros((len(ix), len(other)), bool)
            sizes = np.array([len(probes[i]) for i in ix])
            flat = np.concatenate([probes[i] for i in ix])
            spots = np.minimum(np.searchsorted(other, flat), len(other) - 1)
            hit = other[spots] == flat
            back_probe[np.repeat(np.arange(len(ix)), sizes)[hit], spots[hit]] = True
            xi = rows["unit"][ix]
            for a in range(0, len(pr), 1024):
                p = pr[a : a + 1024]
                r, c = np.nonzero(rows["unit"][p] @ xi.T >= threshold)
                i, j = p[r], ix[c]
                differ = rows["key"][i] != rows["key"][j]
                i, j, c = i[differ], j[differ], c[differ]
                np.add.at(count, i, rows["copies"][j])
                alone = (home[i] != cell) & ~back_probe[c, spot[i]]
                np.add.at(count, j[alone], rows["copies"][i[alone]])
                label = local_roots(n, i, j, label)
        has = np.flatnonzero(count)
        off = np.flatnonzero(rows["node"][label] != rows["node"])
        return rows["key"][has], count[has], rows["node"][off], rows["node"][label[off]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
            task = table.column("task").to_numpy()
            at = table.column("at").to_numpy()
            cuts = [0, *(np.flatnonzero((task[1:] != task[:-1]) | (at[1:] != at[:-1])) + 1).tolist(), len(task)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = table.slice(a, b - a).combine_chunks()
                rows = {k: part.column(k).to_numpy() for k in ("at", "side", "key", "node", "copies", "cell")}
                rows["unit"] = unit(matrix(part.column("vec").combine_chunks()))
                key, count, x, y = block(rows, [np.array(p) for p in part.column("probes").to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([key, x])), pa.array(np.concatenate([count, y])), pa.array(np.repeat([False, True], [len(key), len(x)]))], names=["a", "b", "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            task, at = table.column("task").to_numpy(), table.column("at").to_numpy()
            last = np.flatnonzero((task != task[-1]) | (at != at[-1]))
            if len(last):  # the last task's rows may go on in the next batch
                yield from emit(table.slice(0, int(last[-1]) + 1))
                held = table.slice(int(last[-1]) + 1).to_batches()
        if held:
            yield from emit(pa.Table.from_batches(held))

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row."""
    spark = vectors.sparkSession
    reach(spark)
    # floats stay floats on the way: they are widened where they are compared
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vec"))
    rows = rows.withColumn("ok", usable("vec") & F.col("vec_id").isNotNull())
    # two hashes name a vector's class
    rows = rows.withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), F.reverse("vec")))
    classes = materialise(rows.where("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.any_value("vec").alias("vec")).withColumn("dim", F.size("vec")), "classes")
    sizes = dict(classes.groupBy("dim").count().collect())
    centres = {}
    for d, n in sorted(sizes.items()):
        sample = classes.where(F.col("dim") == d).select("vec", "h1", "h2")
        sample = (sample if n <= SAMPLE else sample.where(F.pmod(F.xxhash64("h1", "h2"), F.lit(1 << 20)) < int((1 << 20) * SAMPLE / n))).orderBy("h1", "h2").select("vec").toArrow()
        sample = unit(matrix(sample.column(0).combine_chunks()))
        centres[d] = fit_cells(sample, max(1, min(MOST_CELLS, n // CELL, len(sample)))) if len(sample) else np.eye(1, d)
    keyed = classes.withColumn("key", F.xxhash64("h1", "h2"))
    assigned = materialise(_assign(keyed, centres, margin), "assigned")
    blocks = {}
    for r in assigned.select("cell", F.explode("probes").alias("at")).groupBy("at").agg(F.sum((F.col("cell") == F.col("at")).cast("long")).alias("own"), F.count("*").alias("all")).where(f"own > {INDEX_BLOCK} OR all > {PROBE_BLOCK}").collect():
        blocks[r.at] = (-(-r.own // INDEX_BLOCK), -(-r["all"] // PROBE_BLOCK))  # one row a cell, of few cells

    def many(which: int):
        out = F.lit(1)
        if blocks:
            out = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in blocks.items() for x in (k, v[which])]), F.col("at")), F.lit(1))
        return out

    own_i, own_p = F.pmod(F.col("key"), many(0)).cast("int"), F.pmod(F.col("key"), many(1)).cast("int")
    cols = ["at", "task", "side", "key", "node", "copies", "cell", "probes", "vec"]
    index = assigned.withColumn("at", F.col("cell")).withColumn("own", own_i).withColumn("other", F.explode(F.sequence(F.lit(0), many(1) - 1))).withColumn("task", F.col("own") * 65536 + F.col("other")).withColumn("side", F.lit(0)).select(cols)
    probing = assigned.withColumn("at", F.explode("probes")).withColumn("own", own_p).withColumn("other", F.explode(F.sequence(F.lit(0), many(0) - 1))).withColumn("task", F.col("other") * 65536 + F.col("own")).withColumn("side", F.lit(1)).select(cols)
    found = materialise(index.unionByName(probing).repartition("at", "task").sortWithinPartitions("at", "task").mapInArrow(tidy(_products(threshold)), "a long, b long, edge boolean"), "found")
    degree = found.where("NOT edge").groupBy(F.col("a").alias("key")).agg(F.sum("b").alias("others"))
    same = _same_id(rows, classes)
    components = connected_components(found.where("edge").select("a", "b").unionByName(same))
    known = keyed.join(degree, "key", "left").join(components, "node", "left").select("h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    key = F.struct("h1", "h2")
    out = join_about(rows.select("vec_id", "ok", key.alias("class")), known.select(key.alias("class"), "n_links", "component_id"), "class")
    out = out.select("vec_id", F.when(F.col("ok"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"), F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _same_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between the classes of an id that more than one row has."""
    twice = rows.where("ok").groupBy("vec_id").count().where("count > 1").select("vec_id")
    return rows.where("ok").join(twice, "vec_id").join(classes, ["h1", "h2"]).select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
