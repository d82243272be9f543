"""Incremental runs: files that have arrived since the last run pass the same DataFrame functions as in a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def process_new_files(spark: SparkSession, source: str, schema: StructType | str, step: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, source_format: str = "parquet", files_at_once: int | None = None) -> int:
    """Run ``step`` over the files not seen before and append the rows to ``target`` as Parquet; returns their number of
    batches. What was done is kept in ``checkpoint``: after a failure the run goes on with the batch that failed, whose
    rows replace what it had written."""
    reader = spark.readStream.format(source_format).schema(schema)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    done: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")
        done.append(number)

    query = reader.load(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)
