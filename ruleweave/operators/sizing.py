"""Join-side sizing and lineage cutting shared by the operators.

Broadcasts happen only behind an explicit, measured bound: either the caller
proves it (``limit(k)`` output) or :func:`broadcast_if_small` counts the side
first.  Above the bound the join is left to the planner (sort-merge with AQE
skew splitting).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.session import ensure_checkpoint_dir

# Rows and bytes a dimension-like side may hold and still be broadcast
# (ancestor tables, vertex dictionaries, vocabularies, rule sets).
DEFAULT_BROADCAST_ROWS = 500_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def _width(column: str, kind: T.DataType) -> Column:
    """Bytes of a value: text and binary by length, arrays of text by their joined length, others 8."""
    c = F.col(f"`{column}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        text = isinstance(kind.elementType, T.StringType)
        return F.coalesce(F.octet_length(F.array_join(c, "")) if text else F.size(c) * 8, F.lit(0)) + F.size(c) * 16 + 16
    if isinstance(kind, T.StructType):
        return F.lit(64)
    return F.lit(8)


def is_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows and about ``max_bytes`` bytes (one aggregation, partial sums only)."""
    if max_rows <= 0:
        return False
    n, size = df.agg(F.count(F.lit(1)), F.sum(_row_width(df))).first()
    return n <= max_rows and (size or 0) <= max_bytes


def small_parts(df: DataFrame, by: str, max_rows: int = DEFAULT_BROADCAST_ROWS,
                max_bytes: int = DEFAULT_BROADCAST_BYTES) -> dict:
    """``{value: is it small}`` of the few values of ``by`` that ``df`` holds, all sized by one aggregation."""
    sizes = df.groupBy(by).agg(F.count(F.lit(1)), F.sum(_row_width(df))).collect()
    return {value: n <= max_rows and size <= max_bytes for value, n, size in sizes}


def _row_width(df: DataFrame) -> Column:
    return sum((_width(f.name, f.dataType) for f in df.schema), F.lit(0))


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the side holds at most ``max_rows`` rows.

    The count is one cheap job over a small, usually checkpointed, table; a
    side above the bound is returned unhinted so Spark shuffles it instead.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and return it read back.

    Readers never recompute ``df`` and survive lost executors, and the planner
    knows the size of the files.  Partitions and their order are not kept: what
    depends on them must be a column.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """:func:`cut_lineage` with the row count, which the write itself observes (no second job)."""
    back, n, _ = materialize_sized(df)
    return back, n


def materialize_sized(df: DataFrame) -> tuple[DataFrame, int, int]:
    """:func:`cut_lineage` with rows and bytes (as :func:`is_small` counts them), observed by the write."""
    seen = Observation()
    back = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(_row_width(df)).alias("size")))
    found = seen.get
    if "n" not in found:  # a plan known to be empty may drop the observation
        return back, back.count(), 0
    return back, found["n"], found["size"] or 0


def fits(rows: int, size: int, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether a table of that size may be broadcast."""
    return rows <= max_rows and size <= max_bytes


def spread(scan: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition a raw scan that has fewer partitions than cores.

    A file with a single row group is read by one task, so row-heavy work
    right after the scan (tokenising, exploding, parsing) would run on one
    core; one cheap shuffle of the raw rows spreads it.  Inputs with enough
    partitions (many files or row groups, as at scale) are returned as is.
    Apply it to scans only: reading the partition count plans but runs no job.
    """
    sc = scan.sparkSession.sparkContext
    target = min_partitions or sc.defaultParallelism
    return scan.repartition(target) if scan.rdd.getNumPartitions() < target else scan
