"""Set algebra and whole-row joins on DataFrames (distinct semantics where SQL has them)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Frames whose tags fit a 64-bit mask.
TAGS = 62


def tagged(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows of all frames (columns by position) with ``_mask``, one bit per frame that holds the row.

    One union and one aggregation over all columns: equal rows of a frame combine before the only shuffle, and
    nulls are equal, as in SQL's set operators.
    """
    if len(frames) > TAGS:
        raise ValueError(f"at most {TAGS} frames have a bit")
    columns = frames[0].columns
    marked = [f.toDF(*columns).withColumn("_mask", F.lit(1 << i).cast("long")) for i, f in enumerate(frames)]
    return reduce(DataFrame.union, marked).groupBy(*columns).agg(F.bit_or("_mask").alias("_mask"))


def intersect_all(frames: Sequence[DataFrame]) -> DataFrame:
    """INTERSECT (distinct) of n frames with the same columns, in one shuffle."""
    frames = list(frames)
    while len(frames) > TAGS:
        frames = [intersect_all(frames[:TAGS]), *frames[TAGS:]]
    return tagged(frames).filter(F.col("_mask") == (1 << len(frames)) - 1).drop("_mask")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL (bag) of n frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT, in one shuffle."""
    return tagged([a, b]).filter(F.col("_mask") == 1).drop("_mask")


def join_on_all_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner equi-join on every column of ``right`` (SQL equality: null never matches)."""
    return left.join(right, on=right.columns, how="inner")


def uncovered(population: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """Rows of ``population`` whose key is absent from ``covered`` (left anti join)."""
    return population.join(covered.select(key), key, "left_anti")


def is_subset(a: DataFrame, b: DataFrame, key: str) -> bool:
    """True when every key of ``a`` occurs in ``b`` (one anti-join, stops at the first row)."""
    return uncovered(a, b, key).isEmpty()


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column, value>``: distinct non-null values of each listed column."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    # one pass: every row gives one pair per column, combined before the shuffle
    return df.select(F.explode(items).alias("_it")).select("_it.column", "_it.value").filter(F.col("value").isNotNull()).distinct()
