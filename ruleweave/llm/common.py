"""Shared pieces of the corpus operators: table scans, Arrow slices, scratch tables."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ruleweave.session import ensure_checkpoint_dir

#: Folder that holds the package.
ROOT = str(Path(__file__).resolve().parents[2])
#: Rows and characters handed to a Python function at once.
SLICE_ROWS = 256
#: Slices between two collections of cyclic garbage.
COLLECT_EVERY = 64
#: With this setting a write's shuffle files go when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def share_code(spark: SparkSession) -> None:
    """Lets Python workers import this package from the folder the driver has it in, wherever they start."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts the lineage: readers survive lost executors and never recompute ``df``, so the shuffle files of the write are
    removed at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_slices(df: DataFrame, make: Callable[[], Callable[..., list]], schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """``mapInArrow`` over small row slices.

    ``make()`` runs once per task and returns a function from the slice's
    columns (Python lists) to the output columns (lists of equal length).
    """
    share_code(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        # the functions make many short-lived containers and no cycles; collections would only walk their caches
        gc.disable()
        try:
            for i, part in enumerate(slices(batches, rows)):
                out = fn(*[c.to_pylist() for c in part.columns])
                if out and len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow)
                if i % COLLECT_EVERY == COLLECT_EVERY - 1:
                    gc.collect()
        finally:
            gc.enable()

    return df.mapInArrow(run, schema)
