"""Readers: files to DataFrames. Columns and predicates reach the scan where Spark's own formats are read."""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: File name endings by kind.
EXTENSIONS = {"jsonl": [".jsonl", ".json"], "parquet": [".parquet"], "tar": [".tar"], "warc": [".warc", ".warc.gz"]}
#: Tasks a core from which starting them costs more than even loads gain.
TASKS_A_CORE = 32


def list_files(spark: SparkSession, paths: str | list[str], extensions: list[str] | None = None) -> list[tuple[str, int]]:
    """(path, bytes) of files by Hadoop's file systems: a folder given alone is listed with its subfolders, one in a list
    without them. Sorted by path; hidden files are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out: dict[str, int] = {}
    for path in [paths] if isinstance(paths, str) else paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(conf)
        for status in fs.globStatus(at) or []:
            if status.isFile():
                out[status.getPath().toString()] = status.getLen()
                continue
            found = fs.listFiles(status.getPath(), isinstance(paths, str))
            while found.hasNext():
                f = found.next()
                if f.getPath().getName()[0] not in "._":
                    out[f.getPath().toString()] = f.getLen()
    return sorted((p, n) for p, n in out.items() if not extensions or p.lower().endswith(tuple(extensions)))


def partition_files(files: list[tuple[str, int]], files_per_partition: int | None = None, blocksize: int | None = None, limit: int | None = None) -> list[list[str]]:
    """Groups of files: so many to a group, or as many as ``blocksize`` bytes hold, by size; at most ``limit`` groups."""
    if files_per_partition and blocksize:
        raise ValueError("files_per_partition and blocksize exclude each other")
    if blocksize:
        groups, held = [], 0
        for path, size in sorted(files, key=lambda f: (f[1], f[0])):
            if groups and held + size <= blocksize:
                groups[-1].append(path)
                held += size
            else:
                groups.append([path])
                held = size
    else:
        step = files_per_partition or 1
        groups = [[p for p, _ in files[i : i + step]] for i in range(0, len(files), step)]
    return groups[:limit] if limit is not None else groups


def _project(df: DataFrame, fields: list[str] | None, allow_empty: bool) -> DataFrame:
    if fields:
        there = [c for c in fields if c in df.columns]
        if not there:
            raise ValueError(f"none of the columns {fields} is there")
        df = df.select(*there)
    if not allow_empty and df.isEmpty():
        raise ValueError("no rows; allow_empty=True permits that")
    return df


def read_jsonl(spark: SparkSession, paths: str | list[str], fields: list[str] | None = None, schema: StructType | str | None = None, allow_empty: bool = True, **options) -> DataFrame:
    """A row for each JSON line; columns that some files lack are null there. A schema saves the pass that infers one."""
    reader = spark.read.options(**options)
    return _project((reader.schema(schema) if schema else reader).json(paths), fields, allow_empty)


def read_parquet(spark: SparkSession, paths: str | list[str], fields: list[str] | None = None, merge_schema: bool = True, allow_empty: bool = True, **options) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else paths
    return _project(spark.read.options(**options).option("mergeSchema", merge_schema).parquet(*paths), fields, allow_empty)


def read_manifest(spark: SparkSession, paths: str | list[str], limit: int | None = None) -> DataFrame:
    """A row for each line of a JSONL manifest."""
    df = spark.read.json(paths)
    return df.limit(limit) if limit is not None else df


def resolve_audio_path(df: DataFrame, audio_dir: str, field: str = "audio_filepath", by: str = "basename") -> DataFrame:
    """The field as a path under ``audio_dir``: by its last part, or whole where relative."""
    base = F.element_at(F.split(field, "/"), -1) if by == "basename" else F.col(field)
    joined = F.concat(F.lit(audio_dir.rstrip("/") + "/"), base)
    return df.withColumn(field, joined if by == "basename" else F.when(F.col(field).startswith("/"), F.col(field)).otherwise(joined))


def read_tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    return spark.read.option("sep", "\t").option("quote", "").csv(path).toDF(*names)


def read_records(spark: SparkSession, paths: str | list[str], iterate: Callable[[str, bytes], Iterator[dict]], schema: str, extract: Callable[[dict], dict | None] | None = None, record_limit: int | None = None, file_name_column: str | None = "file_name", error_column: str | None = None) -> DataFrame:
    """Rows that ``iterate(path, bytes)`` yields from each file, each passed through ``extract`` (None drops it); at most
    ``record_limit`` records a file. Rows leave as they come, a thousand at a time. A file that fails gives the rows
    before its failure and, with ``error_column``, a row of its name and the error, which is null in others; without
    it the failure is logged."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    full = ", ".join([schema, *[f"{c} string" for c in (file_name_column, error_column) if c]])
    names = [f.name for f in spark.createDataFrame([], full).schema]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import logging
        from itertools import islice

        def rows(path: str, content: bytes) -> Iterator[dict]:
            own = {file_name_column: path.rpartition("/")[2]} if file_name_column else {}
            try:
                for record in islice(iterate(path, content), record_limit):
                    row = extract(record) if extract else record
                    if row is not None:
                        yield row | own
            except Exception as e:  # one bad file of millions doesn't end the job
                if error_column:
                    yield own | {error_column: f"{type(e).__name__}: {e}"}
                else:
                    logging.getLogger(__name__).exception("reading %s", path)

        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                found = rows(path, content)
                while part := list(islice(found, 1000)):
                    yield pd.DataFrame([[r.get(c) for c in names] for r in part], columns=names)

    return files.mapInPandas(run, full)


def limit_per_file(df: DataFrame, limit: int, file_column: str, order_by: str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(file_column).orderBy(order_by))).where(F.col("_n") <= limit).drop("_n")


INTERLEAVED = "sample_id string NOT NULL, position int NOT NULL, modality string NOT NULL, content_type string, text_content string, binary_content binary, source_ref string, materialize_error string"
_MEDIA = {".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".webp": "image/webp", ".gif": "image/gif", ".bmp": "image/bmp", ".tif": "image/tiff", ".tiff": "image/tiff"}


def _tar_rows(path: str, content: bytes, texts_field: str, images_field: str, sample_id_field: str | None, materialise: bool) -> Iterator[dict]:
    members: dict[str, dict[str, tarfile.TarInfo]] = {}
    with tarfile.open(fileobj=io.BytesIO(content)) as tar:
        for m in tar:
            if m.isfile():
                stem, dot, ending = m.name.rpartition("/")[2].partition(".")
                folder = m.name.rpartition("/")[0]
                members.setdefault(f"{folder}/{stem}" if folder else stem, {})[dot + ending.lower()] = m
        names = {m.name: m for of in members.values() for m in of.values()}
        for key, of in members.items():
            if ".json" not in of:
                continue
            sample = json.loads(tar.extractfile(of[".json"]).read())
            sample_id = str(sample[sample_id_field]) if sample_id_field else key
            base = {"sample_id": sample_id, "content_type": None, "text_content": None, "binary_content": None, "source_ref": None, "materialize_error": None}
            rest = {k: v for k, v in sample.items() if k not in (texts_field, images_field)}
            yield base | {"position": -1, "modality": "metadata", "content_type": "application/json", "text_content": json.dumps(rest, ensure_ascii=False)}
            texts, images = sample.get(texts_field), sample.get(images_field)
            texts = [texts] if isinstance(texts, str) else texts or []
            if images is None:
                images = [None] * len(texts) + [m.name for end, m in of.items() if end in _MEDIA]
            for position, (text, image) in enumerate(zip(*([*x, *[None] * (max(len(texts), len(images)) - len(x))] for x in (texts, images)), strict=True)):
                if text is not None:
                    yield base | {"position": position, "modality": "text", "content_type": "text/plain", "text_content": text}
                elif image is not None:
                    found = names.get(image)
                    row = base | {"position": position, "modality": "image", "content_type": _MEDIA.get("." + image.rpartition(".")[2].lower(), "application/octet-stream")}
                    if found is None:
                        yield row | {"materialize_error": f"no member {image}"}
                    else:
                        row["source_ref"] = json.dumps({"path": path, "member": found.name, "byte_offset": found.offset_data, "byte_size": found.size, "frame_index": None})
                        yield row | ({"binary_content": tar.extractfile(found).read()} if materialise else {})


def read_webdataset(spark: SparkSession, paths: str | list[str], texts_field: str = "texts", images_field: str = "images", sample_id_field: str | None = None, materialise: bool = False) -> DataFrame:
    """Tar shards of JSON samples and images as interleaved rows: a metadata row at position -1, then texts and images
    in their order, images by their place in the shard unless ``materialise``."""
    return read_records(spark, paths, lambda p, c: _tar_rows(p, c, texts_field, images_field, sample_id_field, materialise), INTERLEAVED.replace(" NOT NULL", ""), file_name_column=None)


def read_interleaved_parquet(spark: SparkSession, paths: str | list[str], fields: list[str] | None = None, overrides: dict[str, str] | None = None) -> DataFrame:
    return align_interleaved(read_parquet(spark, paths), overrides).select(*(fields or ["*"]))


def align_interleaved(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Reserved columns first and in their types, missing ones null; own columns after them, cast where overridden."""
    reserved = {f.name: f.dataType.simpleString() for f in df.sparkSession.createDataFrame([], INTERLEAVED).schema}
    own = [c for c in df.columns if c not in reserved]
    cast = overrides or {}
    first = [(F.col(c) if c in df.columns else F.lit(None)).cast(cast.get(c, t)).alias(c) for c, t in reserved.items()]
    return df.select(*first, *[F.col(c).cast(cast[c]) if c in cast else F.col(c) for c in own])


def read_images(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(image_id, image_path, image_data)`` of every image in tar shards."""

    def rows(path: str, content: bytes) -> Iterator[dict]:
        with tarfile.open(fileobj=io.BytesIO(content)) as tar:
            for m in tar:
                if m.isfile() and "." + m.name.rpartition(".")[2].lower() in _MEDIA:
                    yield {"image_id": m.name.rpartition("/")[2].rpartition(".")[0], "image_path": f"{path}/{m.name}", "image_data": tar.extractfile(m).read()}

    return read_records(spark, paths, rows, "image_id string, image_path string, image_data binary", file_name_column=None)


def read_videos(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``(path, length, content)`` of video files."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.lower("path").rlike(r"\.(mp4|mov|avi|mkv|webm)$")).select("path", "length", "content")
    return df.limit(limit) if limit is not None else df


def read_pdf_manifest(spark: SparkSession, path: str, file_name_field: str = "file_name", file_names_field: str = "cc_pdf_file_names", limit: int | None = None, per_partition: int = 10) -> DataFrame:
    """A row for each PDF of a manifest whose rows name one or several, dealt to tasks of ``per_partition`` PDFs; to larger
    ones where those would be more than TASKS_A_CORE tasks a core."""
    df = spark.read.json(path)
    if file_names_field in df.columns:
        df = df.withColumn(file_name_field, F.explode(file_names_field)).drop(file_names_field)
    if limit is not None:
        df = df.limit(limit)
    most = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    return df.repartition(min(most, max(1, -(-df.count() // per_partition))))


@dataclass(frozen=True)
class RangeReader:
    """Fetches byte ranges of stored files: an adapter for columns (file, offset, length)."""

    fetch: Callable[[str, int, int], bytes]

    def read(self, df: DataFrame, file_col: str = "warc_filename", offset_col: str = "warc_record_offset", length_col: str = "warc_record_length", out_col: str = "binary_content", drop_failed: bool = True) -> DataFrame:
        fetch = self.fetch

        def run(files: pd.Series, offsets: pd.Series, lengths: pd.Series) -> pd.Series:
            def one(f, o, n):
                try:
                    return fetch(f, int(o), int(n))
                except Exception:  # an unreachable range is a null
                    return None

            return pd.Series([one(*x) for x in zip(files, offsets, lengths, strict=True)], dtype="object")

        run.__annotations__ = dict.fromkeys(("files", "offsets", "lengths", "return"), pd.Series)
        out = df.withColumn(out_col, F.pandas_udf(run, "binary")(file_col, offset_col, length_col))
        return out.where(F.col(out_col).isNotNull()) if drop_failed else out


def read_wav_tree(spark: SparkSession, folder: str, limit: int | None = None, path_field: str = "audio_filepath") -> DataFrame:
    """``(audio_filepath, duration)`` of the WAV files in a folder and below; a duration of -1 for those that can't be read."""
    from sievework.operators.segments import wav_duration

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.wav").load(folder)
    files = files.limit(limit) if limit is not None else files
    return files.select(F.col("path").alias(path_field), wav_duration(F.col("content")).alias("duration"))


def read_image_dataset(spark: SparkSession, paths: str | list[str], image_field: str = "image", id_field: str | None = None, limit: int | None = None) -> DataFrame:
    """``(image_id, image_path, image_data)`` and the other columns of a Parquet image dataset whose images are structs
    ``{bytes, path}``; ids are those of a column, or hashes of the bytes."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    df = df.limit(limit) if limit is not None else df
    own = F.col(id_field).cast("string") if id_field else F.md5(f"{image_field}.bytes")
    return df.select(own.alias("image_id"), F.col(f"{image_field}.path").alias("image_path"), F.col(f"{image_field}.bytes").alias("image_data"), *[c for c in df.columns if c not in (image_field, id_field)])


def parquet_info(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(path, rows, row_groups, metadata_bytes)`` of Parquet files, from their footers alone; read by the executors."""
    found = [f for f, _ in list_files(spark, paths, EXTENSIONS["parquet"])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for frame in frames:
            rows = []
            for path in frame["path"]:
                store, at = fs.FileSystem.from_uri(path if not path.startswith("file:/") or path.startswith("file:///") else path.replace("file:/", "file:///", 1))
                about = pq.read_metadata(at, filesystem=store)
                rows.append((path, about.num_rows, about.num_row_groups, about.serialized_size))
            yield pd.DataFrame(rows, columns=["path", "rows", "row_groups", "metadata_bytes"])

    listed = spark.createDataFrame([(f,) for f in found], "path string")
    return listed.mapInPandas(run, "path string, rows long, row_groups long, metadata_bytes long")
