"""Writers: DataFrames to files. A mode is one of append, overwrite, error; ``ignore`` means append, as files beside those
that are there."""

from __future__ import annotations

import io
import json
import tarfile
from array import array
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = {"ignore": "append", "append": "append", "overwrite": "overwrite", "error": "errorifexists"}


def _mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {sorted(MODES)}")
    return MODES[mode]


def write_jsonl(df: DataFrame, path: str, fields: list[str] | None = None, mode: str = "ignore", **options) -> None:
    """JSON lines; null fields are written as null."""
    df.select(*(fields or df.columns)).write.mode(_mode(mode)).options(**{"ignoreNullFields": "false"} | options).json(path)


def write_parquet(df: DataFrame, path: str, fields: list[str] | None = None, mode: str = "ignore", **options) -> None:
    df.select(*(fields or df.columns)).write.mode(_mode(mode)).options(**options).parquet(path)


def write_manifest(df: DataFrame, path: str, skip_field: str | None = None, mode: str = "ignore") -> None:
    """A JSON line for each row; rows flagged in ``skip_field`` are left out."""
    write_jsonl(df if skip_field is None else df.where(~F.coalesce(F.col(skip_field), F.lit(False))), path, mode=mode)


def write_valid_samples(df: DataFrame, path: str, valid_field: str = "is_valid", valid_only: bool = True) -> None:
    write_jsonl(df.where(F.col(valid_field)) if valid_only else df, path)


@contextmanager
def _draft(path: str, name: str) -> Iterator:
    """A file to write to that appears whole: written beside its place and moved. A repeated attempt writes the same bytes."""
    from pyarrow import fs

    store, top = fs.FileSystem.from_uri(path)
    store.create_dir(top, recursive=True)
    draft = f"{top}/{name}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
    with store.open_output_stream(draft, compression=None, buffer_size=1 << 20) as f:
        yield f
    store.move(draft, f"{top}/{name}")


def _put(path: str, name: str, raw: bytes) -> None:
    with _draft(path, name) as f:
        f.write(raw)


def _files(df: DataFrame, write: Callable[[int, Iterator[pd.DataFrame]], Iterator[tuple[str, int]]]) -> list[tuple[str, int]]:
    """(file, rows) of what ``write(partition, frames)`` has written in each partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, rows in write(TaskContext.get().partitionId(), frames):
            yield pd.DataFrame({"file": [name], "rows": [rows]})

    return [tuple(r) for r in df.mapInPandas(run, "file string, rows long").collect()]


#: Codes of the token types in an index file: fixed values.
TOKEN_TYPES = {"int32": 4, "uint16": 8}


def index_bytes(sizes: Sequence[int], dtype: str) -> bytes:
    """Index of a token file: magic, version 1, type code, sequence and document counts, sizes, byte offsets, documents."""
    item = np.dtype(dtype).itemsize
    offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) * item)])[:-1] if sizes else np.zeros(0, np.int64)
    return b"MMIDIDX\x00\x00" + (1).to_bytes(8, "little") + bytes([TOKEN_TYPES[dtype]]) + len(sizes).to_bytes(8, "little") + (len(sizes) + 1).to_bytes(8, "little") + np.array(sizes, "<i4").tobytes() + offsets.astype("<i8").tobytes() + np.arange(len(sizes) + 1, dtype="<i8").tobytes()


def write_token_pairs(df: DataFrame, path: str, encode: Callable[[list[str]], list[list[int]]], vocabulary: int, text_field: str = "text", end_id: int | None = None, batch: int = 1000) -> list[tuple[str, int]]:
    """A ``.bin`` of ids and a ``.idx`` for each partition: 16 bits where the vocabulary fits, else 32."""
    dtype = "uint16" if vocabulary <= 65_536 else "int32"

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
        for frame in frames:
            texts = frame[text_field].fillna("").tolist()
            for at in range(0, len(texts), batch):
                for ids in encode(texts[at : at + batch]):
                    yield np.array([*ids, end_id] if end_id is not None else ids, dtype)

    def write(part: int, frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int]]:
        sizes, texts = array("q"), encoded(frames)
        if (ids := next(texts, None)) is not None:
            with _draft(path, f"part-{part:05d}.bin") as f:
                while ids is not None:
                    sizes.append(len(ids))
                    f.write(ids.tobytes())
                    ids = next(texts, None)
            _put(path, f"part-{part:05d}.idx", index_bytes(sizes, dtype))
            yield f"part-{part:05d}", len(sizes)

    return _files(df.select(text_field), write)


def read_token_pair(bin_bytes: bytes, idx_bytes: bytes) -> list[np.ndarray]:
    """Documents of a token file and its index."""
    code, n = idx_bytes[17], int.from_bytes(idx_bytes[18:26], "little")
    dtype = next(k for k, v in TOKEN_TYPES.items() if v == code)
    sizes = np.frombuffer(idx_bytes, "<i4", n, 34)
    return np.split(np.frombuffer(bin_bytes, np.dtype(dtype)), np.cumsum(sizes)[:-1]) if n else []


def read_token_pairs(spark: SparkSession, path: str, most: int = 1 << 20) -> DataFrame:
    """``(ids)``: a row for each document of the token files in a folder, by their indexes; a file is read in batches of
    about ``most`` bytes, or of one longer document."""
    from sievework.sources.readers import list_files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for name in (n for b in batches for n in b.column(0).to_pylist()):
            store, at = fs.FileSystem.from_uri(name if not name.startswith("file:/") or name.startswith("file:///") else name.replace("file:/", "file:///", 1))
            with store.open_input_stream(at, compression=None) as index, store.open_input_stream(f"{at.removesuffix('.idx')}.bin", compression=None) as ids:
                head = index.read(34)
                left, dtype = int.from_bytes(head[18:26], "little"), np.dtype(next(k for k, v in TOKEN_TYPES.items() if v == head[17]))
                while left:
                    sizes = np.frombuffer(index.read(4 * min(left, 1 << 16)), "<i4").astype(np.int64)
                    left -= len(sizes)
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    lo = 0
                    while lo < len(sizes):
                        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most // dtype.itemsize, "right")) - 1)
                        values = np.frombuffer(ids.read(int(ends[hi] - ends[lo]) * dtype.itemsize), dtype).astype(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array((ends[lo : hi + 1] - ends[lo]).astype(np.int32)), pa.array(values))], names=["ids"])
                        lo = hi

    listed = [(f,) for f, _ in list_files(spark, path, [".idx"])]
    return spark.createDataFrame(listed, "path string").mapInArrow(run, "ids array<long>")


def settle_errors(df: DataFrame, policy: str = "error") -> DataFrame:
    """Interleaved rows by what is to happen where content couldn't be read: error, warn, drop_row or drop_sample."""
    bad = F.col("materialize_error").isNotNull()
    if policy == "error" and not (one := df.where(bad).limit(1)).isEmpty():
        raise ValueError(f"content couldn't be read: {one.first()['materialize_error']}")
    if policy == "drop_row":
        return df.where(~bad)
    if policy == "drop_sample":
        return df.join(df.where(bad).select("sample_id").distinct(), "sample_id", "left_anti")
    if policy not in ("error", "warn"):
        raise ValueError(f"policy {policy!r} is none of error, warn, drop_row, drop_sample")
    return df


def write_interleaved_parquet(df: DataFrame, path: str, on_error: str = "error", mode: str = "ignore") -> None:
    write_parquet(settle_errors(df, on_error), path, mode=mode)


def write_webdataset(df: DataFrame, path: str, partitions: int | None = None, on_error: str = "error") -> list[tuple[str, int]]:
    """A tar shard for each partition: a JSON of each sample, and its images; a sample's rows are together, in order."""
    rows = settle_errors(df, on_error)
    dealt = (rows.repartition(partitions, "sample_id") if partitions else rows.repartition("sample_id")).sortWithinPartitions("sample_id", "position")

    def write(part: int, frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int]]:
        out, n = io.BytesIO(), 0
        tar = tarfile.open(fileobj=out, mode="w")

        def add(name: str, raw: bytes) -> None:
            info = tarfile.TarInfo(name)
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))

        def close(rows: list[dict]) -> None:
            key = str(rows[0]["sample_id"]).replace("/", "_")
            meta, texts, images = {}, [], []
            for r in rows:
                if r["modality"] == "metadata":
                    meta = json.loads(r["text_content"] or "{}")
                    continue
                image = None
                if r["modality"] == "image" and r["binary_content"] is not None:
                    image = f"{key}.{r['position']}.{(r['content_type'] or 'image/bin').rpartition('/')[2]}"
                    add(image, bytes(r["binary_content"]))
                texts.append(r["text_content"] if r["modality"] == "text" else None)
                images.append(image)
            add(f"{key}.json", json.dumps(meta | {"texts": texts, "images": images}, ensure_ascii=False).encode())

        held: list[dict] = []
        for frame in frames:
            for row in frame.to_dict("records"):
                if held and held[0]["sample_id"] != row["sample_id"]:
                    close(held)
                    n, held = n + 1, []
                held.append(row)
        if held:
            close(held)
            n += 1
        tar.close()
        if n:
            _put(path, f"part-{part:05d}.tar", out.getvalue())
            yield f"part-{part:05d}.tar", n

    return _files(dealt, write)


def write_images(df: DataFrame, path: str, per_tar: int = 1000, id_field: str = "image_id", data_field: str = "image_data") -> list[tuple[str, int]]:
    """Tar shards of images, ``per_tar`` in each, and beside each a Parquet of the other columns with their member's name."""

    def write(part: int, frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int]]:
        roll, held = 0, []

        def close(frame: pd.DataFrame) -> str:
            out, names = io.BytesIO(), []
            with tarfile.open(fileobj=out, mode="w") as tar:
                for key, raw in zip(frame[id_field], frame[data_field], strict=True):
                    info = tarfile.TarInfo(f"{key}.jpg")
                    info.size = len(raw)
                    names.append(info.name)
                    tar.addfile(info, io.BytesIO(raw))
            stem = f"part-{part:05d}-{roll:05d}"
            about = io.BytesIO()
            frame.drop(columns=data_field).assign(member=names, tar_file=f"{stem}.tar").to_parquet(about)
            _put(path, f"{stem}.tar", out.getvalue())
            _put(path, f"{stem}.parquet", about.getvalue())
            return f"{stem}.tar"

        for frame in frames:
            held.append(frame)
            whole = pd.concat(held, ignore_index=True)
            while len(whole) >= per_tar:
                yield close(whole[:per_tar]), per_tar
                roll, whole = roll + 1, whole[per_tar:].reset_index(drop=True)
            held = [whole]
        if held and len(held[0]):
            yield close(held[0]), len(held[0])

    return _files(df, write)


def write_clips(df: DataFrame, path: str, id_field: str = "clip_id", data_field: str = "content", ending: str = "mp4") -> list[tuple[str, int]]:
    """A media file for each clip under ``clips``, and its other columns as JSON under ``metas``."""

    def write(_: int, frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int]]:
        for frame in frames:
            for row in frame.to_dict("records"):
                raw = row.pop(data_field)
                if raw is not None:
                    _put(f"{path}/clips", f"{row[id_field]}.{ending}", bytes(raw))
                _put(f"{path}/metas", f"{row[id_field]}.json", json.dumps(row, default=str).encode())
                yield str(row[id_field]), 1

    return _files(df, write)
