"""Operators that change which rows there are: ids, splitting, joining, chunking, merging."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.operators.harness import require
from sievework.plans.tables import materialise


def add_id(df: DataFrame, id_field: str = "id", prefix: str | None = None, overwrite: bool = False, order_by: list[str] | None = None) -> DataFrame:
    """A unique id for each row: ``prefix_n`` or ``n``.

    Without ``order_by`` ids are unique and increase within a partition, and cost no shuffle. With it they run from 0
    without gaps in that order: partitions are sorted by range, kept in a table, since ranges come from a sample and would
    be others when made again, and numbered after a count of their rows.
    """
    if id_field in df.columns and not overwrite:
        raise ValueError(f"column {id_field!r} exists")
    df = df.drop(id_field)
    if order_by is None:
        number = F.monotonically_increasing_id()
        named = F.concat(F.lit(f"{prefix}_"), number.cast("string")) if prefix else number
        return df.withColumn(id_field, named)
    laid = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id() % F.lit(1 << 33))
    laid = materialise(laid, "ordered")
    sizes = laid.groupBy("_part").count().collect()  # one row a partition
    before, starts = 0, {}
    for r in sorted(sizes, key=lambda r: r["_part"]):
        starts[r["_part"]] = before
        before += r["count"]
    offset = F.lit(0).cast("long")
    if starts:
        offset = F.create_map(*[F.lit(x) for k, v in starts.items() for x in (k, v)])[F.col("_part")]
    number = (F.col("_at") + offset).cast("long")
    named = F.concat(F.lit(f"{prefix}_"), number.cast("string")) if prefix else number
    return laid.withColumn(id_field, named).drop("_part", "_at")


def split_documents(df: DataFrame, separator: str, text_field: str = "text", segment_id_field: str = "segment_id", regex: bool = False) -> DataFrame:
    """A row for each part of a text, numbered from 0 in ``segment_id_field``. Null text gives no part."""
    require(df, [text_field])
    pattern = separator if regex else "\\Q" + separator.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    others = [c for c in df.columns if c not in (text_field, segment_id_field)]
    parts = df.select(*others, F.posexplode(F.split(text_field, pattern, -1)).alias(segment_id_field, text_field))
    return parts.select(*[c for c in df.columns if c != segment_id_field], segment_id_field)


def join_documents(df: DataFrame, separator: str = "\n\n", text_field: str = "text", segment_id_field: str = "segment_id", document_id_field: str = "id", drop_segment_id_field: bool = True, max_length: int | None = None, length_field: str | None = None) -> DataFrame:
    """Segments of a document in order, joined into one row, or into rows of at most ``max_length``.

    Other columns have their first non-null value by segment (of a joined row's first segment with ``max_length``).
    Rows without a document id are dropped. Documents are joined whole, wherever their segments lie.
    """
    require(df, [text_field, segment_id_field, document_id_field])
    if (max_length is None) != (length_field is None):
        raise ValueError("max_length and length_field go together")
    df = df.where(F.col(document_id_field).isNotNull())
    if max_length is None:
        ordered = F.array_sort(F.collect_list(F.struct(segment_id_field, text_field)))
        others = [c for c in df.columns if c not in (text_field, segment_id_field, document_id_field)]
        first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(segment_id_field))).alias(c) for c in others]
        joined = df.groupBy(document_id_field).agg(F.array_join(F.transform(ordered, lambda s: s[text_field]), separator).alias(text_field), F.min(segment_id_field).alias(segment_id_field), *first)
        return joined.select(*[c for c in df.columns if c != segment_id_field or not drop_segment_id_field])

    def repack(group: pd.DataFrame) -> pd.DataFrame:
        out: list[dict] = []
        for row in group.sort_values(segment_id_field, kind="stable").to_dict("records"):
            size = row[length_field] + len(separator) + (out[-1][length_field] if out else 0)
            if out and size <= max_length:
                out[-1][text_field] += separator + row[text_field]
                out[-1][length_field] = size
            else:
                out.append(row | {segment_id_field: len(out)})
        return pd.DataFrame(out, columns=group.columns)

    joined = df.groupBy(document_id_field).applyInPandas(repack, df.schema)
    return joined.drop(segment_id_field) if drop_segment_id_field else joined


def split_by_tokens(df: DataFrame, count: Callable[[list[str]], list[int]], max_tokens: int = 8000, separator: str = "\n\n", text_field: str = "text", chunk_id_field: str = "chunk_id", n_tokens_field: str = "n_tokens") -> DataFrame:
    """Paragraphs packed greedily into chunk rows of at most ``max_tokens``, as ``count`` counts a batch of texts; a longer
    paragraph is a chunk of its own. Empty text gives one empty chunk."""
    require(df, [text_field])
    others = [c for c in df.columns if c not in (chunk_id_field, n_tokens_field)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                parts = (row[text_field] or "").split(separator)
                sizes, glue = count(parts), count([separator])[0]
                chunks: list[list] = []
                for part, size in zip(parts, sizes, strict=True):
                    if chunks and chunks[-1][1] + glue + size <= max_tokens:
                        chunks[-1][0].append(part)
                        chunks[-1][1] += glue + size
                    else:
                        chunks.append([[part], size])
                rows += [row | {text_field: separator.join(p), chunk_id_field: i, n_tokens_field: n} for i, (p, n) in enumerate(chunks)]
            yield pd.DataFrame(rows, columns=[*others, chunk_id_field, n_tokens_field])

    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([df.schema[c] for c in others] + [StructField(chunk_id_field, LongType()), StructField(n_tokens_field, LongType())])
    return df.select(*others).mapInPandas(run, schema)


def merge_chunks(df: DataFrame, group_by: list[str], text_field: str = "cleaned_text", raw_text_field: str | None = "text", chunk_id_field: str = "chunk_id", no_content: list[str] | None = None, sum_columns: list[str] | None = None, max_text_length: int = 900_000, separator: str = "\n") -> DataFrame:
    """Chunks of a document merged into a row, without repeated chunk ids and chunks that have nothing.

    Of rows with one chunk id the first by its columns stays. Texts are joined in order, ``sum_columns`` summed, other
    columns have their first non-null value. Merged texts over ``max_text_length`` characters are dropped.
    """
    require(df, [*group_by, text_field, chunk_id_field])
    rest = [c for c in df.columns if c not in (*group_by, chunk_id_field)]
    one = df.groupBy(*group_by, chunk_id_field).agg(F.min(F.struct(*rest)).alias("r")).select(*group_by, chunk_id_field, "r.*")
    full = one.where(F.col(text_field).isNotNull() & ~F.col(text_field).isin("", "\n", *(no_content or [])))
    texts = [text_field] + ([raw_text_field] if raw_text_field in df.columns else [])

    def gathered(c: str) -> Column:
        if c in texts:
            ordered = F.array_sort(F.collect_list(F.struct(F.col(chunk_id_field).alias("k"), F.col(c).alias("v"))))
            return F.array_join(F.transform(ordered, lambda s: s["v"]), separator).alias(c)
        if c in (sum_columns or []):
            return F.sum(c).alias(c)
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col(chunk_id_field))).alias(c)

    merged = full.groupBy(*group_by).agg(*[gathered(c) for c in rest], F.min(chunk_id_field).alias(chunk_id_field))
    return merged.where(~F.col(text_field).isin("", "\n") & (F.length(text_field) <= max_text_length)).select(*df.columns)


def center_crop(text: Column, characters: int = 10_000) -> Column:
    """The middle ``characters`` of a text."""
    start = F.greatest(F.floor((F.length(text) - characters) / 2), F.lit(0)).cast("int")
    return F.substring(text, start + 1, F.lit(characters))


def sort_by_length(df: DataFrame, length_field: str, order_field: str = "_order") -> DataFrame:
    """Rows of each partition by a length, with their former order in ``order_field``; :func:`restore_order` undoes it."""
    return df.withColumn(order_field, F.monotonically_increasing_id()).sortWithinPartitions(length_field, order_field)


def restore_order(df: DataFrame, order_field: str = "_order") -> DataFrame:
    return df.sortWithinPartitions(order_field).drop(order_field)


def shuffle_on(df: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """Rows dealt by a hash of ``columns``."""
    return df.repartition(partitions, *columns) if partitions else df.repartition(*columns)


def consecutive_pairs(df: DataFrame, group_by: str, order_by: str, value: str) -> DataFrame:
    """(left, right) of neighbouring values within a group."""
    window = Window.partitionBy(group_by).orderBy(order_by)
    return df.select(group_by, F.col(value).alias("left"), F.lead(value).over(window).alias("right")).where(F.col("right").isNotNull())
