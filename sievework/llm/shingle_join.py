"""Near-duplicate texts: word-shingle sets with a Jaccard similarity of at least a threshold.

Three steps, each of whose candidates are decided by the sets themselves:

1. SimHash fingerprints of the sets, probed by the generalised pigeonhole principle (:mod:`sievework.llm.simhash`) within
   ``RADIUS`` bits: this joins the closest texts, most of all links, at little cost.
2. What such a radius can't promise, an exact way finds. Shingles have one global order, rare ones first (any order is
   right; this one keeps buckets small). Two sets of sizes m and n with similarity s share at least s * max(m, n)
   shingles, so the first n - ceil(s * n) + 1 of each have one in common: texts that share such a shingle are
   candidates, where sizes and places allow it. First, neighbours in a bucket that lie in different components, in an
   order that changes from round to round while many of them are similar,
3. then all other pairs of a bucket that lie in different components by then; components need no link within one.

Equal sets are one class from the start. Shingles are known by 64-bit hashes, sets by 128-bit ones.

Edge cases: null text is empty; a text of fewer words than a shingle is one shingle; texts without words are equal. Rows
with a null id link with nothing. An empty table gives an empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm import simhash
from sievework.llm._runtime import connected_components, forget, join_about, materialise, small_batches, tidy
from sievework.llm.simhash import BLOCK, BROADCAST_IDS, SEED, fingerprint

#: Bits in which fingerprints of candidates of the first step may differ.
RADIUS = 6
#: The most rounds in which neighbours in buckets are decided, and the share of similar pairs (one of so many) that makes
#: another worth while: near copies of one text join within few, before all pairs of those still apart are looked at.
ROUNDS, FRUITFUL, FEW = 10, 50, 50_000
#: Documents sampled for the order of shingles, and the most shingles known as common: more only make buckets smaller.
SAMPLE, COMMON = 20_000, 500_000
#: Pairs of a bucket that a task looks at together, and those whose counts it compares together.
PAIRS, STEP = 200_000, 40_000
#: Ranges of hashes whose shingles are counted, up to 255 each: counts that differ show shingles that aren't shared.
RANGES = 256


#: Odd multipliers of the hashes, and bytes of a text that are in work at once.
_BASE, _STEP, _MIX, PART = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0xD6E8FEB86659FD93), 1 << 17
_LETTERS = np.random.default_rng(SEED).integers(0, 1 << 64, 256, np.uint64)
_LETTERS[65:91] = _LETTERS[97:123]  # A-Z as a-z
_BLANKS = np.isin(np.arange(256), [32, *range(9, 14)])
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE to the powers 0 to n - 1, modulo 2**64, and their inverses."""
    up = [np.append(np.uint64(1), np.full(n - 1, b, np.uint64)).cumprod(dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return up[0], up[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _word_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of each word of a text's bytes: a polynomial in its letters, mixed; all words at once, from running sums."""
    blank = np.concatenate([[True], _BLANKS[raw], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edges[::2], edges[1::2]
    size = 1 << max(len(raw) - 1, PART - 1).bit_length()
    up, down = _powers(size) if size <= 2 * PART else _powers.__wrapped__(size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[raw] * up[: len(raw)], dtype=np.uint64)])
    return _mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """64-bit hashes of a text's distinct word shingles, sorted: a polynomial in the hashes of their words, mixed."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    found, at, held = [np.zeros(0, np.uint64)], 0, np.zeros(0, np.uint64)
    while at < len(raw):
        end = len(raw)
        if at + PART < end and (blank := _BLANK.search(raw, at + PART)):
            end = blank.start()
        held = np.concatenate([held, _word_hashes(np.frombuffer(raw, np.uint8, end - at, at))])
        if len(held) >= size:
            found.append(_shingles(held, size))
            held = held[len(held) - size + 1 :]
        at = end
    if len(found) == 1 and len(held):  # fewer words than a shingle: all of them are one
        found.append(_shingles(held, len(held)))
    return np.unique(np.concatenate(found))


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        out = out * _STEP + words[j : len(words) - k + 1 + j]
    return _mixed(out)


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed numbers."""
    import xxhash

    low, high = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64).tolist()
    return low, high


def range_counts(shingles: np.ndarray) -> bytes:
    return np.minimum(np.bincount((shingles % np.uint64(RANGES)).astype(np.int64), minlength=RANGES), 255).astype(np.uint8).tobytes()


def prefix(shingles: np.ndarray, common: np.ndarray, rank: np.ndarray, similarity: Fraction) -> np.ndarray:
    """The first shingles of a set by rank, then hash, of which similar sets share one; ``common`` is sorted."""
    n = len(shingles)
    if not n:
        return shingles
    order = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        order = np.where(common[at] == shingles, rank[at], 0)
    least = -(-n * similarity.numerator // similarity.denominator)
    return shingles[np.lexsort((shingles, order))[: n - least + 1]]


def _common(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that more than two documents of a sample have, sorted, and in how many."""
    n = docs.count()
    sample = docs if n <= SAMPLE else docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * SAMPLE / n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(0)]
            found, count = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count.astype(np.int64))], names=["token", "n"])

    counts = sample.select("text").mapInArrow(tidy(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n > 2")
    got = counts.orderBy(F.desc("n"), "token").limit(COMMON).toArrow()
    token, count = got.column("token").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(token)
    return token[order], count[order]


def text_classes(docs: DataFrame, shingle: int, similarity: Fraction) -> tuple[DataFrame, DataFrame]:
    """``prints(doc_id, h1, h2)`` of each row of ``docs(doc_id, text)`` with an id, and ``classes(node, doc_id, h1, h2, n,
    fp, counts, prefix)``: the distinct sets, the smallest id of each and a number of its own."""
    docs = docs.where("doc_id IS NOT NULL")
    sent = docs.sparkSession.sparkContext.broadcast(_common(docs, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, prefixes = np.zeros((batch.num_rows, 2), np.int64), np.zeros(batch.num_rows, np.int32), []
            prints, counts = np.zeros(batch.num_rows, np.uint64), []
            for i, text in enumerate(batch.column(1)):
                found = shingle_set(text.as_py(), shingle)
                digests[i], sizes[i], prints[i] = set_digest(found), len(found), fingerprint(found)
                counts.append(range_counts(found))
                prefixes.append(prefix(found, *sent.value, similarity).view(np.int64))
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(sizes), pa.array(prints.view(np.int64)), pa.array(counts, pa.binary()), pa.array(map(half_counts, counts), pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "h1", "h2", "n", "fp", "counts", "halves", "prefix"])

    prints = materialise(docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, h1 long, h2 long, n int, fp long, counts binary, halves binary, prefix array<long>"), "prints")
    # one row of each set, chosen by ids alone; only then are the wide columns fetched
    low = prints.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"))
    one = prints.dropDuplicates(["doc_id", "h1", "h2"]).join(low, ["h1", "h2", "doc_id"])
    classes = materialise(one.select(F.monotonically_increasing_id().alias("node"), "doc_id", "h1", "h2", "n", "fp", "counts", "halves", "prefix"), "classes")
    ids = materialise(prints.select("doc_id", "h1", "h2"), "ids")
    forget(prints)
    return ids, classes


def _possible(classes: DataFrame, pairs: DataFrame, similarity: Fraction) -> DataFrame:
    """``pairs(a, b)`` without those whose range counts show that too few shingles are shared."""
    up, down = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, RANGES).astype(np.int16) for i in (4, 5))
            most = (m + n - np.abs(x - y).sum(1, dtype=np.int64)) // 2
            yield batch.select([0, 1]).filter(pa.array(most * (up + down) >= (m + n) * up))

    side = lambda node, n, counts: classes.select(F.col("node").alias(node), F.col("n").alias(n), F.col("counts").alias(counts))
    both = pairs.join(side("a", "m", "x"), "a").join(side("b", "n", "y"), "b")
    return materialise(both.select("a", "b", "m", "n", "x", "y").mapInArrow(tidy(run), "a long, b long"), "possible")


def _decide(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets are similar. Sets are made only for classes in pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(1)]
            digests = np.array([set_digest(s) for s in sets], np.int64).reshape(-1, 2)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "h1", "h2", "shingles"])

    if pairs.isEmpty():
        return pairs
    pairs = _possible(classes, pairs, similarity)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = materialise(classes.select("node", "doc_id", "h1", "h2").join(nodes, "node", "left_semi"), "wanted")
    n = wanted.count()
    small = F.broadcast if n <= BROADCAST_IDS else lambda df: df
    texts = docs.select("doc_id", "text").join(small(wanted.select("doc_id").distinct()), "doc_id", "left_semi")
    found = texts.mapInArrow(tidy(run), "doc_id long, h1 long, h2 long, shingles array<long>").join(small(wanted), ["doc_id", "h1", "h2"])
    sets = materialise(found.select("node", "shingles"), "sets")
    if sets.count() > n:  # rows equal in id and set
        sets = materialise(sets.groupBy("node").agg(F.any_value("shingles").alias("shingles")), "sets")
    few = F.broadcast(pairs) if pairs.count() <= BROADCAST_IDS else pairs
    both = sets.withColumnsRenamed({"node": "a", "shingles": "x"}).join(few, "a").join(sets.withColumnsRenamed({"node": "b", "shingles": "y"}), "b")
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    near = shared * (similarity.numerator + similarity.denominator) >= (F.size("x") + F.size("y")).cast("long") * similarity.numerator
    out = materialise(both.where(near).select("a", "b"), "links")
    for table in (sets, wanted, pairs):
        forget(table)
    return out


def half_counts(counts: bytes) -> bytes:
    """Counts of ranges held to 15, two in a byte: a pair's least difference by them is no larger than by the counts."""
    x = np.minimum(np.frombuffer(counts, np.uint8), 15)
    return (x[::2] << 4 | x[1::2]).tobytes()


def _pairs(similarity: Fraction):
    """Pairs of a cell in different components that sizes, places and range counts allow; rows (token, cell, side, n, at,
    comp, node, halves) sorted by (token, cell, side). Where a cell has two blocks, those of side 1 meet those of side 0; else all meet."""
    up, down = similarity.numerator, similarity.denominator

    def meet(x: np.ndarray, halves: np.ndarray) -> np.ndarray:
        new = np.flatnonzero(np.concatenate([[True], (x[1:, :2] != x[:-1, :2]).any(1)]))
        length = np.diff(np.append(new, len(x)))
        run = np.repeat(np.arange(len(new)), length)
        cross = x[:, 1] >= 0
        zeros = np.bincount(run[x[:, 2] == 0], minlength=len(new))
        place = np.arange(len(x)) - new[run]
        count = np.where(cross, np.where(x[:, 2] == 1, zeros[run], 0), place)
        rows = np.flatnonzero(count)
        count, first = count[rows], new[run[rows]]
        out, done, upto = [np.zeros((0, 2), np.int64)], 0, np.cumsum(count)
        while done < len(rows):
            end = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + PAIRS, "right")))
            c = count[done:end]
            a = np.repeat(rows[done:end], c)
            b = np.repeat(first[done:end], c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
            apart = x[a, 5] != x[b, 5]
            a, b = a[apart], b[apart]
            most = np.minimum(x[a, 3] - x[a, 4], x[b, 3] - x[b, 4])
            a, b = (v[most * (up + down) >= (x[a, 3] + x[b, 3]) * up] for v in (a, b))
            for at in range(0, len(a), STEP):  # some 10 MB of counts at a time
                i, j = a[at : at + STEP], b[at : at + STEP]
                apart = sum(np.abs((halves[i] >> s & 15).astype(np.int8) - (halves[j] >> s & 15).astype(np.int8)).sum(1, dtype=np.int64) for s in (0, 4))
                both = x[i, 3] + x[j, 3]
                fine = (both - apart) // 2 * (up + down) >= both * up
                i, j = i[fine], j[fine]
                out.append(np.unique(np.sort(np.stack([x[i, 6], x[j, 6]], 1), axis=1), axis=0))
            done = end
        return np.concatenate(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(x: np.ndarray, halves: np.ndarray) -> Iterator[pa.RecordBatch]:
            got = meet(x, halves)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(got[:, 0])), pa.array(np.ascontiguousarray(got[:, 1]))], names=["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)], 1)
            held.append((x, np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint8).reshape(-1, RANGES // 2)))
            if sum(len(h[0]) for h in held) < 20_000 or (held[0][0][0, :2] == x[-1, :2]).all():
                continue
            x, halves = (np.concatenate(v) for v in zip(*held, strict=True))
            cut = int(np.flatnonzero((x[:, :2] != x[-1, :2]).any(1))[-1]) + 1
            yield from emit(x[:cut], halves[:cut])  # the last cell may go on in the next batch
            held = [(x[cut:], halves[cut:])]
        if held:
            yield from emit(*(np.concatenate(v) for v in zip(*held, strict=True)))

    return run


def links(docs: DataFrame, classes: DataFrame, shingle: int, similarity: Fraction, block: int = BLOCK, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` between similar classes, whose components are those of all similar pairs.

    A bucket of more than ``block`` rows is cut into blocks, each two of which meet in a cell.
    """
    up, down = similarity.numerator, similarity.denominator
    rows = classes.select("node", F.col("n").cast("long").alias("n"), F.posexplode("prefix").alias("at", "token"))
    often = rows.groupBy("token").count().where("count > 1").select("token", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    shared = materialise(rows.join(often, "token").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "shared")

    # closest texts, by their fingerprints
    close = materialise(simhash.links(classes.select("node", "fp"), radius, block).distinct(), "pairs")
    first = _decide(docs, classes, close, shingle, similarity)

    # neighbours in a bucket that lie in different components
    def label(found: DataFrame) -> DataFrame:
        known = connected_components(found)
        out = shared.join(known, "node", "left").withColumn("comp", F.coalesce("component", "node"))
        return materialise(out.select("token", "node", "n", F.col("at").cast("long").alias("at"), "comp", "own", "blocks"), "labelled")

    found, labelled = first, label(first)
    for seed in range(ROUNDS):
        beside = Window.partitionBy("token", "own").orderBy(F.xxhash64(F.lit(seed), "node"), "node")
        chain = labelled.select("comp", "node", "n", "at", *[F.lag(c).over(beside).alias(f"{c}2") for c in ("comp", "node", "n", "at")]).where("comp2 <> comp")
        chain = chain.where(F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2")) * (up + down) >= (F.col("n") + F.col("n2")) * up)
        near = materialise(chain.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct(), "pairs")
        joined = _decide(docs, classes, near, shingle, similarity)
        looked, hits = near.count(), joined.count()
        found = found.unionByName(joined)
        forget(labelled)
        labelled = label(found)
        if looked <= FEW or hits * FRUITFUL < looked:  # so few that all may be looked at, or most are apart for good
            break

    # the other pairs, where they join components
    apart = labelled.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("token")
    last = F.col("blocks") - 1
    # cell -1 - i holds block i, cell i * 2**31 + j the blocks i < j
    cell = F.transform(F.sequence(F.lit(0), last), lambda k: F.when(k == F.col("own"), F.struct((-1 - k.cast("long")).alias("cell"), F.lit(0).cast("long").alias("side"))).otherwise(F.struct((F.least(k, "own").cast("long") * (1 << 31) + F.greatest(k, "own")).alias("cell"), (k < F.col("own")).cast("long").alias("side"))))
    cells = labelled.join(apart, "token", "left_semi").join(classes.select("node", "halves"), "node").withColumn("c", F.explode(cell)).select("token", "c.cell", "c.side", "n", "at", "comp", "node", "halves")
    met = materialise(cells.repartition("token", "cell").sortWithinPartitions("token", "cell", "side").mapInArrow(tidy(_pairs(similarity)), "a long, b long").distinct(), "pairs")
    third = _decide(docs, classes, met, shingle, similarity)
    for table in (labelled, shared):
        forget(table)
    return found.unionByName(third)


def kept_texts(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, h1, h2, kept)`` for each row with an id: whether it has the smallest id, and of equal ids the smallest
    digest, of its group of similar texts. Texts of the same id are texts of their own."""
    small_batches(docs.sparkSession)
    share = Fraction(similarity).limit_denominator(1000)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints, classes = text_classes(docs, shingle, share)
    placed = classes.join(connected_components(links(docs, classes, shingle, share)), "node", "left")
    least = placed.groupBy(F.coalesce("component", "node").alias("c")).agg(F.min(F.struct("doc_id", "h1", "h2")).alias("r")).select("r.*", F.lit(True).alias("kept"))
    out = materialise(prints.join(least, ["doc_id", "h1", "h2"], "left").select("doc_id", "h1", "h2", F.coalesce("kept", F.lit(False)).alias("kept")), "kept")
    forget(prints)
    forget(classes)
    return out


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of similar texts: that with the smallest id and, of equal ids, the smallest
    digest. Texts of one id are texts of their own. Rows with a null id stay."""
    found = kept_texts(docs, shingle, similarity)
    per_id = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or("kept").alias("kept"))
    aside = materialise(per_id.where("n > 1 OR NOT kept").select("doc_id", "n"), "aside")
    ids = aside.select(F.col("doc_id").alias("_gone"))
    # ids alone are sent to the documents where their number is known to be small; else both sides are shuffled
    kept = docs.join(F.broadcast(ids) if aside.count() <= BROADCAST_IDS else ids, docs["doc_id"].cast("long") == F.col("_gone"), "left_anti")
    twice = materialise(aside.where("n > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return kept
    again = docs.select(F.struct(*docs.columns).alias("r"), F.col("doc_id").cast("long").alias("i"), digests(F.col("text"), shingle).alias("d")).join(twice.select(F.col("doc_id").alias("i")), "i", "left_semi")
    again = again.select("i", "r", F.col("d.h1").alias("h1"), F.col("d.h2").alias("h2")).join(found.where("kept").select(F.col("doc_id").alias("i"), "h1", "h2").distinct(), ["i", "h1", "h2"], "left_semi")
    return kept.unionByName(again.groupBy("i", "h1", "h2").agg(F.any_value("r").alias("r")).select("r.*"))


def digests(text, shingle: int = 5):
    """Column of the digest ``(h1, h2)`` of a text's shingle set."""

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([set_digest(shingle_set(t, shingle)) for t in texts], columns=["h1", "h2"])

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, "h1 long, h2 long")(text)
