"""Filters of interleaved text and image rows: (sample_id, position, modality, ...). A metadata row stands at -1."""

from __future__ import annotations

import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions import text as T


def valid() -> Column:
    """Rows of a known modality in a place that it may have."""
    meta = F.col("modality") == "metadata"
    return F.coalesce((meta & (F.col("position") == -1)) | (F.col("modality").isin("text", "image") & (F.col("position") >= 0)), F.lit(False))


def keep_rows(df: DataFrame, keep: Column, drop_invalid: bool = True) -> DataFrame:
    """Rows that ``keep`` holds for, places numbered anew within a sample; metadata of a sample without content goes."""
    rows = df.where(F.coalesce(keep, F.lit(False)) & valid() if drop_invalid else F.coalesce(keep, F.lit(False)))
    by_sample = Window.partitionBy("sample_id")
    content = F.col("modality") != "metadata"
    counted = rows.withColumn("_content", F.sum(content.cast("int")).over(by_sample))
    place = F.row_number().over(Window.partitionBy("sample_id", content).orderBy("position", "modality")) - 1
    return counted.where("_content > 0").withColumn("position", F.when(content, place).otherwise(F.lit(-1)).cast("int")).drop("_content")


def image_size(raw: bytes | None) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, GIF, BMP, JPEG or WebP image."""
    if not raw or len(raw) < 26:
        return None
    if raw[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", raw[16:24])
    if raw[:6] in (b"GIF87a", b"GIF89a"):
        return struct.unpack("<HH", raw[6:10])
    if raw[:2] == b"BM":
        w, h = struct.unpack("<ii", raw[18:26])
        return w, abs(h)
    if raw[:4] == b"RIFF" and raw[8:12] == b"WEBP" and len(raw) >= 30:
        if raw[12:16] == b"VP8X":
            return int.from_bytes(raw[24:27], "little") + 1, int.from_bytes(raw[27:30], "little") + 1
        if raw[12:16] == b"VP8L":
            bits = int.from_bytes(raw[21:25], "little")
            return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
        w, h = struct.unpack("<HH", raw[26:30])
        return w & 0x3FFF, h & 0x3FFF
    if raw[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(raw):
            if raw[at] != 0xFF:
                at += 1
                continue
            kind = raw[at + 1]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", raw[at + 5 : at + 9])
                return w, h
            at += 2 if kind == 0xFF or 0xD0 <= kind <= 0xD9 else 2 + int.from_bytes(raw[at + 2 : at + 4], "big")
    return None


def _image_score(function: Callable[[bytes], float | None]) -> Callable[[Column], Column]:
    def run(raw: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else function(bytes(x)) for x in raw], dtype="object")

    run.__annotations__ = {"raw": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")


def aspect_ratio(df: DataFrame, low: float = 1.0, high: float = 2.0) -> DataFrame:
    """Without images whose width to height lies outside; undecodable ones go."""

    def ratio(raw: bytes) -> float | None:
        size = image_size(raw)
        return size[0] / size[1] if size and size[1] else None

    return keep_rows(df, (F.col("modality") != "image") | _image_score(ratio)("binary_content").between(low, high))


def laplacian_variance(pixels) -> float:
    """Sharpness of a grey image: variance of its Laplacian, edges mirrored."""
    import numpy as np

    x = np.pad(np.asarray(pixels, float), 1, mode="reflect")
    return float((x[:-2, 1:-1] + x[2:, 1:-1] + x[1:-1, :-2] + x[1:-1, 2:] - 4 * x[1:-1, 1:-1]).var())


def blur(df: DataFrame, decode: Callable[[bytes], object], least: float = 100.0) -> DataFrame:
    """Without images less sharp than ``least``; ``decode`` gives grey pixels, or None."""

    def score(raw: bytes) -> float | None:
        pixels = decode(raw)
        return None if pixels is None else laplacian_variance(pixels)

    return keep_rows(df, (F.col("modality") != "image") | (_image_score(score)("binary_content") >= least))


def qr_code(df: DataFrame, code_share: Callable[[bytes], float | None], most: float = 0.05) -> DataFrame:
    """Without images of which a QR code covers ``most`` or more."""
    return keep_rows(df, (F.col("modality") != "image") | (_image_score(code_share)("binary_content") < most))


def image_text_similarity(df: DataFrame, image_vector: str, text_vector: str, least: float = 0.15) -> DataFrame:
    """Without images whose largest product with a text vector of their sample is under ``least``. Vectors are columns."""
    texts = df.where((F.col("modality") == "text") & F.col(text_vector).isNotNull()).select("sample_id", F.col(text_vector).alias("_t"))
    images = df.where((F.col("modality") == "image") & F.col(image_vector).isNotNull()).select("sample_id", "position", F.col(image_vector).alias("_i"))
    dot = F.aggregate(F.zip_with("_i", "_t", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x)
    best = images.join(texts, "sample_id").groupBy("sample_id", "position").agg(F.max(dot).alias("_best")).where(F.col("_best") >= least)
    near = df.join(best, ["sample_id", "position"], "left")
    return keep_rows(near, (F.col("modality") != "image") | F.col("_best").isNotNull()).drop("_best")


def image_to_text_ratio(df: DataFrame, low: float = 0.0, high: float = float("inf")) -> DataFrame:
    """Samples whose images to words (at least one) lie within."""
    words = F.when(F.col("modality") == "text", F.size(T.words(F.coalesce("text_content", F.lit("")))))
    sums = df.groupBy("sample_id").agg(F.sum((F.col("modality") == "image").cast("int")).alias("images"), F.coalesce(F.sum(words), F.lit(0)).alias("words"))
    fine = sums.where((F.col("images") / F.greatest(F.col("words"), F.lit(1))).between(low, high)).select("sample_id")
    return keep_rows(df.join(fine, "sample_id", "left_semi"), F.lit(True))


def materialise(df: DataFrame, fetch: Callable[[str, str | None, int, int], bytes], only_missing: bool = True) -> DataFrame:
    """Image bytes by their place (path, member, offset, size); failures are told in ``materialize_error``."""

    def run(frames):
        import json

        for frame in frames:
            content, errors = frame["binary_content"].tolist(), frame["materialize_error"].tolist()
            for i, (kind, ref) in enumerate(zip(frame["modality"], frame["source_ref"], strict=True)):
                if kind != "image" or ref is None or (only_missing and content[i] is not None):
                    continue
                try:
                    r = json.loads(ref)
                    content[i], errors[i] = fetch(r["path"], r.get("member"), r["byte_offset"], r["byte_size"]), None
                except Exception as e:
                    errors[i] = f"{type(e).__name__}: {e}"
            yield frame.assign(binary_content=content, materialize_error=errors)

    return df.mapInPandas(run, df.schema)
