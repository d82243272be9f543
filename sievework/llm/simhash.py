"""SimHash near-duplicates, found by the generalised pigeonhole principle.

A document's fingerprint has a bit set where over half of its word shingles' hashes have it. Two fingerprints that
differ in at most ``radius`` bits are linked. For parts of the bits with thresholds t_i that sum to
``radius - parts + 1`` (each -1 or more), any such pair differs in at most t_i bits of some part i: so indexing each
part's code and probing it with every code within t_i loses no pair. Correlated bits go to the same part, and the
thresholds come from dynamic programming over the candidate counts estimated from statistics of all fingerprints.

Edge cases: null text is empty; a text of fewer words than a shingle is one shingle; no words give fingerprint zero,
linked like any other. Rows with the same id are one vertex. Rows with a null id link with nothing and get a null
component. Empty tables give empty results. Columns other than id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm._runtime import connected_components, join_about, local_roots, materialise, small_batches, tidy

SEED = 42
#: Bytes of a text whose words are in memory at once, and what divides words.
PART, _BLANK = 1 << 20, re.compile(rb"[\x20\x09-\x0D]")
#: Rows of a bucket that one task compares with others; fuller buckets are cut into a grid of blocks.
BLOCK = 4096
#: Ids up to which a list of them is broadcast (some 50 MB).
BROADCAST_IDS = 2_000_000
#: Relative costs of a shuffled probe row and of a compared pair, for the planner.
ROW_COST, PAIR_COST = 1000.0, 2.0


def word_parts(text: str, size: int) -> Iterator[list[bytes]]:
    """A text's words in parts of a megabyte of text, each begun by the ``size - 1`` words before it; ASCII letters in
    lower case."""
    raw, at, before = text.encode("utf-8", "surrogatepass").lower(), 0, []
    while at < len(raw):
        end = at + PART
        if end < len(raw):  # to the next white space
            found = _BLANK.search(raw, end)
            end = found.start() if found else len(raw)
        new = raw[at:end].split()
        if new:
            yield before + new
            before = (before + new)[-(size - 1) :] if size > 1 else []
        at = end


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each word shingle (uint64), or of the whole sequence of fewer words."""
    import xxhash

    hashed, out, held = xxhash.xxh64_intdigest, [np.zeros(0, np.uint64)], 0
    for words in word_parts(text, size):
        k = min(size, len(words))
        if k < size:  # the text's only part, or a first one of few words
            held = words
            continue
        held = None
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
        ends = ends[k - 1 :].tolist()
        out.append(np.fromiter((hashed(joined[i:j], SEED) for i, j in zip(starts, ends, strict=True)), np.uint64, len(starts)))
    if held:
        return np.array([hashed(b" ".join(held), SEED)], np.uint64)
    return np.concatenate(out)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have; ties and no hashes give zero."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(np.ascontiguousarray(hashes[at : at + (1 << 14)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``; shingles count as often as they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.fromiter((fingerprint(shingle_hashes(t.as_py() or "", shingle)) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), "doc_id long, fp long")


def bit_statistics(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, how many have both; over all rows, gathered as 2,080 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((64, 64))
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 1 << 14):
                bits = np.unpackbits(np.ascontiguousarray(fp[at : at + (1 << 14)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
                n += len(bits)
        i, j = np.triu_indices(64)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1).astype(np.int32)), pa.array(np.append(j, -1).astype(np.int32)), pa.array(np.append(both[i, j], n).astype(np.int64))], names=["i", "j", "n"])

    rows = classes.select("fp").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both, n = np.zeros((64, 64)), 0
    for i, j, k in rows:
        if i < 0:
            n = int(k)
        else:
            both[i, j] = both[j, i] = k
    return n, both


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Parts of near-equal width; each starts from the most correlated bit left and takes the bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, out = list(range(64)), []
    for k in range(parts):
        width = 64 * (k + 1) // parts - 64 * k // parts
        part = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < width:
            part.append(max(left, key=lambda b: (corr[b, part].sum(), -b)))
            left.remove(part[-1])
        out.append(sorted(part))
    return out


def near_share(both: np.ndarray, n: int, part: list[int]) -> np.ndarray:
    """Estimated share of pairs that differ in at most 0, 1, ... bits of a part: a Poisson binomial over the bits' own
    shares, taken to the power by which their correlation lowers the effective width."""
    p = np.diag(both)[part] / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = (both[np.ix_(part, part)] / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, 1)
    dist = np.array([1.0])
    for q in 2 * p * (1 - p):
        dist = np.convolve(dist, [1 - q, q])
    return np.minimum(1, np.cumsum(dist)) ** (len(part) / max(1.0, float((corr**2).sum())))


def plan(n: int, both: np.ndarray, radius: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part with a threshold of 0 or more, at the least estimated cost over the numbers of parts."""
    best = (math.inf, [])
    for parts in range(1, min(radius + 1, 16) + 1):
        groups = group_bits(both, n, parts)
        cost = []
        for part in groups:
            share, probes, row = near_share(both, n, part), 0.0, [0.0]
            for t in range(min(radius, len(part)) + 1):
                probes += math.comb(len(part), t)
                row.append(n * (probes + 1) / 2 * ROW_COST + n * n / 2 * float(share[t]) * PAIR_COST if probes <= 20_000 else math.inf)
            cost.append(row)
        # table[s]: least cost of the parts so far whose thresholds, each counted from -1, sum to s
        table, need = {0: (0.0, ())}, radius + 1
        for row in cost:
            new: dict[int, tuple[float, tuple[int, ...]]] = {}
            for s, (c, ts) in table.items():
                for t, add in enumerate(row[: need - s + 1]):
                    if c + add < new.get(s + t, (math.inf, ()))[0]:
                        new[s + t] = (c + add, (*ts, t - 1))
            table = new
        if need in table and table[need][0] < best[0]:
            best = (table[need][0], [(g, t) for g, t in zip(groups, table[need][1], strict=True) if t >= 0])
    return best[1]


def _codes(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    code = np.zeros(len(fp), np.uint64)
    for j, b in enumerate(bits):
        code |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(j)
    return code


def _rows(classes: DataFrame, parts: list[tuple[list[int], int]], probes: bool) -> DataFrame:
    """``(key, node, fp)``: index rows, or the probe rows of the other codes within the thresholds. A key is a code,
    its part, and a last bit that is 1 in probe rows.

    Of two codes that differ, only the smaller probes the larger: each pair of codes meets once.
    """
    masks = [np.array([sum(1 << b for b in c) for k in range(1, t + 1) for c in combinations(range(len(bits)), k)], np.uint64) for bits, t in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for k, (bits, _) in enumerate(parts):
                code = _codes(fp.view(np.uint64), bits)
                step = max(1, 200_000 // max(1, len(masks[k]) if probes else 1))
                for at in range(0, len(fp) if len(masks[k]) or not probes else 0, step):
                    own = code[at : at + step]
                    if probes:
                        other = own[:, None] ^ masks[k][None, :]
                        row, column = np.nonzero(other > own[:, None])
                        key = other[row, column]
                    else:
                        row, key = np.arange(len(own)), own
                    key = (key << np.uint64(5)) | np.uint64(2 * k + probes)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(pa.array(x[at : at + step][row]) for x in (node, fp))], names=["key", "node", "fp"])

    return classes.select("node", "fp").mapInArrow(tidy(run), "key long, node long, fp long")


def _compare(radius: int):
    """Links of a bucket's index rows with one another and with its probe rows, as a spanning forest. Input sorted by
    (cell, key), so that a bucket's index rows come first; rows (key, cell, node, fp)."""

    def pairs(x: np.ndarray) -> np.ndarray:
        key, node, fp = x[:, 0], x[:, 2], np.ascontiguousarray(x[:, 3]).view(np.uint64)
        bucket = np.stack([key >> 1, x[:, 1] >> 1], 1)
        new = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]).any(1)]))
        run = np.zeros(len(key), np.int64)
        run[new] = 1
        run = np.cumsum(run) - 1
        indexed = (key & 1) == 0
        index_n = np.bincount(run[indexed], minlength=len(new))
        place = np.arange(len(key)) - new[run]
        # an index row meets those before it, a probe row all; in a cell off the diagonal of a cut bucket rows of the
        # second block stand as probe rows
        count = np.where(indexed, place, index_n[run])
        rows = np.flatnonzero(count)
        count, first = count[rows], new[run[rows]]
        _, at, back = np.unique(node, return_index=True, return_inverse=True)
        label = at[back]  # rows of one node are one vertex
        done, upto = 0, np.cumsum(count)
        while done < len(rows):
            end = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + 200_000, "right")))
            c = count[done:end]
            a = np.repeat(rows[done:end], c)
            b = np.repeat(first[done:end], c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
            ok = np.bitwise_count(fp[a] ^ fp[b]) <= radius
            label = local_roots(len(key), a[ok], b[ok], label)
            done = end
        out = np.flatnonzero(node[label] != node)
        return np.unique(np.stack([node[out], node[label[out]]], 1), axis=0) if len(out) else np.zeros((0, 2), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(x: np.ndarray) -> pa.RecordBatch:
            got = pairs(x)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(got[:, 0])), pa.array(np.ascontiguousarray(got[:, 1]))], names=["a", "b"])

        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], 1))
            size += batch.num_rows
            first, last = held[0][0], held[-1][-1]
            if size < 50_000 or (first[0] >> 1 == last[0] >> 1 and first[1] >> 1 == last[1] >> 1):
                continue
            x = np.concatenate(held)
            cut = int(np.flatnonzero((x[:, 0] >> 1 != last[0] >> 1) | (x[:, 1] >> 1 != last[1] >> 1))[-1]) + 1
            yield emit(x[:cut])  # the last bucket may go on in the next batch
            held, size = [x[cut:]], len(x) - cut
        if size:
            yield emit(np.concatenate(held))

    return run


def links(classes: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` between nodes of ``classes(node, fp)`` that join what lies within ``radius``; a spanning forest of
    each bucket's links, never all its pairs.

    A bucket of more than ``block`` index rows is cut into blocks. Blocks i <= j of its index rows meet in a cell, the
    rows of j as probe rows if they differ; a probe row meets every block.
    """
    spark = classes.sparkSession
    n, both = bit_statistics(classes)
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    parts = plan(n, both, radius)
    index, probes = _rows(classes, parts, False), _rows(classes, parts, True)
    full = materialise(index.groupBy("key").count().where(F.col("count") > block).select(F.shiftright("key", 1).alias("bucket"), F.ceil(F.col("count") / block).cast("int").alias("blocks")), "full")
    rest = ["node", "fp"]
    rows = index.unionByName(probes)
    if full.isEmpty():
        rows = rows.select("key", F.lit(0).cast("long").alias("cell"), *rest)
    else:
        met = rows.withColumn("bucket", F.shiftright("key", 1)).join(full, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own, last = F.pmod(F.xxhash64(*rest), F.col("blocks")).cast("int"), F.col("blocks") - 1
        cell = lambda i, j: (i.cast("long") * (1 << 31) + j.cast("long")) * 2
        probe = (F.col("key") % 2) == 1
        # (cell, 1 if the row probes there): for an index row of block b the cells (i, b) with i <= b and (b, j) with j > b
        as_index = F.transform(F.sequence(F.lit(0), last), lambda k: F.when(k < F.col("own"), F.struct(cell(k, F.col("own")).alias("cell"), F.lit(1).alias("probe"))).otherwise(F.struct(cell(F.col("own"), k).alias("cell"), F.lit(0).alias("probe"))))
        as_probe = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(cell(k, k).alias("cell"), F.lit(1).alias("probe")))
        spread = met.withColumn("own", own).withColumn("c", F.explode(F.when(probe, as_probe).otherwise(as_index)))
        rows = spread.select((F.col("bucket") * 2 + F.col("c.probe")).alias("key"), F.col("c.cell").alias("cell"), *rest)
    dealt = rows.repartition(F.shiftright("key", 1), F.col("cell")).sortWithinPartitions("cell", "key")
    return dealt.mapInArrow(tidy(_compare(radius)), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row: the smallest id that links reach. Equal fingerprints are one vertex
    from the start, so a group of exact copies costs one row."""
    prints = materialise(fingerprints(docs, shingle, id_col, text_col), "prints")
    classes = materialise(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    found = connected_components(links(classes, radius).unionByName(_same_id(prints, classes)))
    placed = materialise(classes.join(found, "node", "left").select("fp", "node", F.coalesce("component", "node").alias("component_id")), "placed")
    out = join_about(prints, placed.select("fp", "component_id"), "fp")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def _same_id(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between the classes of an id that more than one row has."""
    twice = prints.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    return prints.join(twice, "doc_id").distinct().join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
