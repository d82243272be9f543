"""Shared-folder tables, file access and small steps that operators of this subpackage have in common."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sievework.plans.graph import connected_components, local_roots
from sievework.plans.skew import join_about
from sievework.plans.tables import forget, fresh_path, materialise, reach, scratch, shared_dir, table

__all__ = ["connected_components", "forget", "fresh_path", "join_about", "local_roots", "materialise", "null_safe_key", "open_fs", "reach", "scratch", "shared_dir", "small_batches", "table", "tidy"]

#: Rows of an Arrow batch of whole texts: some 3 MB of usual documents, so that long ones don't fill a worker.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to BATCH_ROWS rows in this session, for operators whose rows have whole texts; workers find this
    library."""
    reach(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def tidy(run):
    """``run``, a function of an iterator of batches, that gives freed memory back to the system when its task ends:
    Python workers outlive tasks, and their allocators keep what they have taken."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()

    return whole


def _give_back() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def open_fs(uri: str):
    """(filesystem, path) of a URI, for executors that write or read whole files."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def null_safe_key(column: str):
    """A never-null string that differs for null and for every value."""
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(column).cast("string")))
