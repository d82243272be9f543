"""Best-fit packing of token pieces into sequences, by exact-complement hashing.

Only lengths matter to a packing, and there are at most ``size`` of them: the plan is made on the driver from a
histogram of lengths, and its cost and memory don't grow with the corpus. An index of the sums of one, two and three
lengths gives the combinations that exactly fill the gap beside a length, which are used as often as the counts allow;
a gap without one takes the longest length that fits, and the index is asked again for the rest of it. Pieces then find
their place by their rank within their length; those of ``size`` tokens are sequences of their own.

Edge cases: null text is empty; an empty text is a piece of one end token. Repeated rows are packed each. A table
without rows gives none. Columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm._encoder import encoder
from sievework.llm._runtime import materialise, small_batches, tidy

#: Groups into which the pieces of one length are dealt for ranking, and those of the full length, of which there are the
#: most: the histogram has (size - 1) * SALTS + FULL_SALTS rows at most.
SALTS, FULL_SALTS = 64, 16_384


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: each text's ids and an end id, cut where longer than ``size``.
    All pieces of a cut document have ``size`` ids but the first, which may have fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder(tokenizer).encode(t.as_py() for t in batch.column(1))):
                raw = np.append(ids, end_id).astype("<u4")
                cuts = [0, *range(len(raw) % size or size, len(raw) + 1, size)] if len(raw) > size else [0, len(raw)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(raw[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), "doc_id long, piece int, start long, length long, ids_crc32 long")


class SumIndex:
    """Sums of one, two and three of the available lengths, each sum with the longest length of its combinations.

    ``left`` are the counts, which only fall: an entry whose lengths are used up is passed by for good. A sum of three is
    its longest length and a sum of two from lengths no longer than that, so the index has at most size**2 entries.
    """

    def __init__(self, left: np.ndarray, size: int):
        self.left, self.size, have = left, size, left > 0
        lengths = np.flatnonzero(have)[::-1]
        self.pairs: list[list[int]] = [[] for _ in range(size + 1)]
        self.triples: list[list[int]] = [[] for _ in range(size + 1)]
        self.passed = np.zeros((2, size + 1), np.int64)
        shortest = np.full(size + 1, size + 1)  # of the longer lengths of a sum's pairs
        for total in range(2, size + 1):
            longer = lengths[(2 * lengths >= total) & (lengths < total)]
            longer = longer[have[total - longer]]
            if len(longer):
                self.pairs[total], shortest[total] = longer.tolist(), longer[-1]
        for total in range(3, size + 1):
            longest = lengths[(3 * lengths >= total) & (lengths < total - 1)]
            self.triples[total] = longest[shortest[total - longest] <= longest].tolist()

    def enough(self, *lengths: int) -> bool:
        return all(self.left[x] >= lengths.count(x) for x in lengths)

    def _entries(self, kind: int, total: int) -> Iterator[int]:
        entries, at = (self.pairs, self.triples)[kind][total], int(self.passed[kind, total])
        while at < len(entries) and not (self.left[entries[at]] and (kind or self.left[total - entries[at]])):
            at += 1
        self.passed[kind, total] = at
        for x in entries[at:]:
            if self.left[x]:
                yield x

    def find(self, total: int, parts: int, beside: tuple[int, ...]) -> tuple[int, ...] | None:
        """``parts`` lengths that sum to ``total``, available together with those ``beside`` them; the longest first."""
        if parts == 1:
            return (total,) if self.enough(*beside, total) else None
        if parts == 2:
            return next(((a, total - a) for a in self._entries(0, total) if self.enough(*beside, a, total - a)), None)
        three = ((a, b, total - a - b) for a in self._entries(1, total) for b in self._entries(0, total - a) if b <= a)
        return next((x for x in three if self.enough(*beside, *x)), None)


def complete(index: SumIndex, first: int) -> tuple[int, ...]:
    """A sequence begun by the length ``first``: its gap filled exactly by one, two or three lengths; where none are
    available, the longest length that fits goes in and what is left of the gap is tried again."""
    lengths, gap = (first,), index.size - first
    while gap:
        if rest := next((r for parts in (1, 2, 3) if (r := index.find(gap, parts, lengths))), None):
            return (*lengths, *rest)
        fits = next((x for x in range(gap, 0, -1) if index.left[x] > lengths.count(x)), 0)
        if not fits:
            break
        lengths, gap = (*lengths, fits), gap - fits
    return lengths


def plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) for ``counts[length]`` pieces of each length up to ``size``.

    Sequences are begun by the longest lengths first, each as often as the counts of its lengths allow; so short lengths
    go where few others fit.
    """
    left, out = counts.astype(np.int64).copy(), []
    if left[size]:
        out.append(((size,), int(left[size])))
        left[size] = 0
    index = SumIndex(left, size)
    for longest in range(size - 1, 0, -1):
        while left[longest]:
            lengths = complete(index, longest)
            times = min(int(left[x]) // lengths.count(x) for x in lengths)
            out.append((lengths, times))
            for x in set(lengths):
                left[x] -= times * lengths.count(x)
    return out


def pack(found: DataFrame, size: int = 2048) -> DataFrame:
    """``found``, a table of :func:`pieces`, with ``sequence_id`` and ``offset``. Read twice, so written before."""
    salts = F.when(F.col("length") == size, F.lit(FULL_SALTS)).otherwise(F.lit(SALTS))
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), salts).cast("int"))
    many = np.zeros((size + 1) * SALTS + FULL_SALTS, np.int64)  # by length, then salt
    for length, s, n in salted.groupBy("length", "_salt").count().collect():
        many[length * SALTS + s] = n
    before = np.cumsum(many) - many
    counts = np.append(many[: size * SALTS].reshape(-1, SALTS).sum(1), many[size * SALTS :].sum())
    before -= np.repeat(before[np.arange(size + 1) * SALTS], [*[SALTS] * size, SALTS + FULL_SALTS])
    starts, base, offset, sequence, ranks = [], [], [], 0, [0] * (size + 1)
    for lengths, times in plan(counts, size):
        at = 0
        for x in lengths:
            starts.append((x << 40) + ranks[x])
            base.append(sequence - ranks[x])
            offset.append(at)
            ranks[x] += times
            at += x
        sequence += times
    order = np.argsort(np.array(starts, np.int64))
    starts, base, offset = (np.array(x, np.int64)[order] for x in (starts, base, offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, s, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("length", "_salt", "_rank"))
            rank += before[length * SALTS + s]
            slot = np.searchsorted(starts, (length << 40) + rank, "right") - 1
            keep = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(base[slot] + rank), pa.array(offset[slot])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")).cast("long") - 1)
    return ranked.mapInArrow(tidy(run), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, **columns) -> DataFrame:
    """Tokenize once, to a table in the shared folder, and pack it."""
    return pack(materialise(pieces(docs, tokenizer, size, end_id, **columns), "pieces"), size)
