"""Token-id files with directly addressable codes: any token is read without decoding a block.

An id is cut into 8-bit chunks. Level 0 has the lowest chunk of every id, level k the next chunk of those that need
one; a bitmap beside each level marks the ids that go on, and a rank directory has the number of marks before every
512th. Token i is ``level0[i]``; where its mark is set, its next chunk stands at the number of marks before it in
level 1, and so on. A run of tokens is a run on every level, so documents are decoded by array operations.

File: magic, five u64 (documents, tokens, levels, chunk bits, directory step), ids i64, null marks u8, starts u64
(one more than documents), and for each level its length u64, chunks, bitmap (padded to 8 bytes) and directory u64.
Little-endian.

Edge cases: null text is empty and gives its end id alone. Null ids come first. Rows with the same id are ordered by a
hash of their text. No rows give no file. Columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm._encoder import encoder
from sievework.llm._runtime import fresh_path, materialise, open_fs, small_batches, tidy

MAGIC, CHUNK, STEP = b"SWDAC001", 8, 512
#: A file is closed when it has so many tokens: what a writer or reader holds in memory.
FILE_TOKENS = 4_000_000


def to_bytes(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """A file of documents with ``sizes`` ids each, one after the other in ``ids``."""
    out = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], "u1").tobytes(), np.concatenate([[0], np.cumsum(sizes)]).astype("<u8").tobytes()]
    rest, levels = ids.astype(np.uint32), 0
    while levels == 0 or len(rest):
        more = rest >= 1 << CHUNK
        marks = np.packbits(more, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), STEP), dtype=np.int64))]) if len(more) else np.zeros(1)
        out += [np.array([len(rest)], "<u8").tobytes(), (rest & ((1 << CHUNK) - 1)).astype("u1").tobytes(), marks.tobytes() + bytes(-len(marks) % 8), ranks.astype("<u8").tobytes()]
        rest, levels = rest[more] >> CHUNK, levels + 1
    return MAGIC + np.array([len(doc_ids), len(ids), levels, CHUNK, STEP], "<u8").tobytes() + b"".join(out)


class TokenFile:
    """Random access to a file's tokens and documents, over its bytes or a memory map."""

    def __init__(self, raw):
        raw = memoryview(raw)
        if raw[:8] != MAGIC:
            raise ValueError("not a token file")
        self.n_docs, self.n_tokens, levels, self.bits, self.step = np.frombuffer(raw, "<u8", 5, 8).astype(int).tolist()
        at = 48
        self.doc_ids = np.frombuffer(raw, "<i8", self.n_docs, at)
        self.null = np.frombuffer(raw, "u1", self.n_docs, at := at + 8 * self.n_docs)
        self.starts = np.frombuffer(raw, "<u8", self.n_docs + 1, at := at + self.n_docs).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.levels = []
        for _ in range(levels):
            n = int(np.frombuffer(raw, "<u8", 1, at)[0])
            chunks = np.frombuffer(raw, "u1", n, at := at + 8)
            size = -(-n // 8)
            marks = np.frombuffer(raw, "u1", size, at := at + n)
            ranks = np.frombuffer(raw, "<u8", -(-n // self.step) + 1, at := at + size + -size % 8)
            at += 8 * len(ranks)
            self.levels.append((chunks, marks, ranks))

    def _rank(self, level: int, i: int) -> int:
        """Marks before entry i of a level."""
        _, marks, ranks = self.levels[level]
        first = i // self.step * self.step
        return int(ranks[i // self.step]) + int(np.unpackbits(marks[first // 8 : -(-i // 8)], bitorder="little")[: i - first].sum())

    def token(self, i: int) -> int:
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for level, (chunks, marks, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (level * self.bits)
            if not marks[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, a: int, b: int, level: int = 0) -> np.ndarray:
        """Ids of the tokens from a to b, exclusive."""
        chunks, marks, _ = self.levels[level]
        value = chunks[a:b].astype(np.uint32)
        more = np.unpackbits(marks[a >> 3 : -(-b // 8)], bitorder="little")[a & 7 : (a & 7) + b - a].astype(bool)
        if more.any():
            first = self._rank(level, a)
            value[more] |= self.tokens(first, first + int(more.sum()), level + 1) << np.uint32(self.bits)
        return value

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


def write(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None, file_tokens: int = FILE_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append ``end_id``, and write ids to files under ``path`` in ascending id order.

    Returns the manifest ``(file, part, roll, n_docs, n_tokens)``; files in (part, roll) order hold ascending ids. Texts
    are dealt by ranges of (id, text hash), so that no repeated id fills a task, and encoded after. A file gets its
    name when it is whole: a repeated attempt writes the same bytes under the same name.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = path or fresh_path(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = open_fs(path)
        fs.create_dir(top, recursive=True)
        task = TaskContext.get()
        part, attempt, roll = task.partitionId(), task.taskAttemptId(), 0
        doc_ids, sizes, held, tokens = [], [], [], 0

        def close() -> pa.RecordBatch:
            name = f"{top}/part-{part:06d}-{roll:05d}.dac"
            with fs.open_output_stream(f"{name}.{attempt}", compression=None) as f:
                f.write(to_bytes(doc_ids, sizes, np.concatenate(held)))
            fs.move(f"{name}.{attempt}", name)
            return pa.RecordBatch.from_pydict({"file": [f"part-{part:06d}-{roll:05d}.dac"], "part": pa.array([part], pa.int32()), "roll": pa.array([roll], pa.int32()), "n_docs": [len(doc_ids)], "n_tokens": [tokens]})

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(t.as_py() for t in batch.column(1)), strict=True):
                doc_ids.append(doc_id)
                sizes.append(len(ids) + 1)
                held.append(np.append(ids, end_id).astype(np.uint32))
                tokens += len(ids) + 1
                if tokens >= file_tokens:
                    yield close()
                    roll += 1
                    doc_ids, sizes, held, tokens = [], [], [], 0
        if doc_ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    return materialise(dealt.mapInArrow(tidy(run), "file string, part int, roll int, n_docs long, n_tokens long").withColumn("path", F.lit(path)), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, read back from the files of a manifest."""
    spark = manifest.sparkSession
    # a row for each file of millions of tokens: few enough for one task
    before = F.sum("n_tokens").over(Window.orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    listed = manifest.select(F.concat("path", F.lit("/"), "file").alias("file"), before.alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, at = open_fs(uri)
                with fs.open_input_file(at) as f:
                    t = TokenFile(f.read())
                crc = [zlib.crc32(t.document(k).astype("<u4").tobytes()) for k in range(t.n_docs)]
                yield pa.RecordBatch.from_arrays([pa.array(t.doc_ids, mask=t.null.astype(bool)), pa.array(first + t.starts[:-1]), pa.array(np.diff(t.starts)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, min(manifest.count(), 4 * spark.sparkContext.defaultParallelism))
    return listed.repartition(tasks).mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")
