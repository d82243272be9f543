"""Tables in the shared folder, which cut lineage and outlive executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: The session's limit of an Arrow batch, and ours where it has none: Spark's own is 64 MB for each of an executor's workers.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)
_own: dict[str, str] = {}
_made: list[list[str]] = []


def reach(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver has it, whatever folder the job was started in. On executors
    that don't share that folder the library has to be installed or sent with --py-files. Batches sent to workers are held
    to BATCH_BYTES, unless the session names a size: rows alone don't bound them where rows are texts or recordings."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, BATCH_BYTES)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, so that Spark and other readers mean the same place."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")
    return full if not full.startswith("file:/") or full.startswith("file:///") else full.replace("file:/", "file:///", 1)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one is made only where that is unset in local mode, where
    driver and executors are one process. A cluster has to name one that its machines share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return qualified(spark, named)
    app = spark.sparkContext.applicationId
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="sievework-")
        spark.sparkContext.setCheckpointDir(_own[app])
    return _own[app]


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt to all cores: where a table is one large row group, all that
    comes after would be one task. Scans of more splits are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sievework/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps neither recompute it nor depend on executors."""
    path = fresh_path(df.sparkSession, name)
    if _made:
        _made[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables made within are deleted at the end, but for those made by the function that this yields, which is
    :func:`materialise` otherwise."""
    kept: set[str] = set()

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = materialise(df, name)
        kept.add(_made[-1][-1])
        return out

    _made.append([])
    try:
        yield keep
    finally:
        for path in _made.pop():
            if path not in kept:
                _delete(spark, path.rpartition("/")[0])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(df: DataFrame) -> None:
    """Delete a table made by :func:`materialise`, with the folder that was made for it alone."""
    for top in {f.rpartition("/")[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, top.rpartition("/")[0])
