"""Lance datasets, where the ``lance`` library is installed: fragments are read and written by Spark tasks.

A read is pinned to the version that it finds; a write commits all fragments at once, after the last task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from importlib.util import find_spec

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def _library():
    if not find_spec("lance"):
        raise ImportError("Lance datasets need the lance library")
    import lance

    return lance


def read_lance(spark: SparkSession, path: str, schema: str, columns: list[str] | None = None, row_filter: str | None = None, fragment_ids: list[int] | None = None, fragments_per_task: int = 32, version: int | None = None) -> DataFrame:
    """Rows of a dataset's fragments in ``schema``; columns and the filter reach Lance's own scan."""
    dataset = _library().dataset(path, version=version)
    there = {f.fragment_id for f in dataset.get_fragments()}
    wanted = sorted(set(fragment_ids)) if fragment_ids is not None else sorted(there)
    if missing := set(wanted) - there:
        raise ValueError(f"no fragments {sorted(missing)}")
    pinned = dataset.version
    listed = spark.createDataFrame([(i,) for i in wanted], "fragment int").repartition(max(1, -(-len(wanted) // fragments_per_task)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = _library().dataset(path, version=pinned)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from source.get_fragment(i).to_batches(columns=columns, filter=row_filter)

    return listed.mapInArrow(run, schema)


def write_lance(df: DataFrame, path: str, mode: str = "create") -> int:
    """Write ``df`` as fragments and commit them as one version, whose number is returned. Modes: create, append, overwrite."""
    if mode not in ("create", "append", "overwrite"):
        raise ValueError(f"mode {mode!r} is none of create, append, overwrite")
    lance = _library()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from lance.fragment import write_fragments

        frame = pd.concat(list(frames), ignore_index=True)
        if len(frame):
            made = write_fragments(pa.Table.from_pandas(frame, preserve_index=False), path)
            yield pd.DataFrame({"fragment": [json.dumps(f.to_json()) for f in made]})

    rows = df.mapInPandas(run, "fragment string").collect()  # one row for each fragment
    fragments = [lance.FragmentMetadata.from_json(r.fragment) for r in rows]
    schema = df.limit(0).toArrow().schema
    if mode == "append":
        current = lance.dataset(path)
        operation, base = lance.LanceOperation.Append(fragments), current.version
    else:
        operation, base = lance.LanceOperation.Overwrite(schema, fragments), None
    return lance.LanceDataset.commit(path, operation, read_version=base).version
