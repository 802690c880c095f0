"""Tabular sources: delimited files with a header and inline rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = "\t",
                   header: bool = True) -> DataFrame:
    """Delimited text with a header; every column a string; malformed rows dropped.

    Give ``columns`` to fix the schema up front (no inference pass over the
    data); otherwise the header names are used with string types.
    """
    reader = spark.read.option("sep", sep).option("header", str(header).lower()).option("mode", "DROPMALFORMED")
    if columns is not None:
        schema = StructType([StructField(c, StringType(), True) for c in columns])
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "false").csv(path)


REJECT = "_reject"


def read_with_rejects(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "\t",
                      header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Delimited text with the given columns, all strings, and the lines that don't fit them.

    Rows with too few or too many fields are rejects ``<line>``: whole lines, none lost, so every line of the files is
    in one of the two.  Both are scans of their own; nothing is kept.
    """
    schema = StructType([StructField(c, StringType(), True) for c in [*columns, REJECT]])
    parsed = (spark.read.schema(schema).option("sep", sep).option("header", str(header).lower()).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", REJECT).option("enforceSchema", "true").csv(path))
    # the reader finds rejects only where the other columns are read too: any hash of them is at least the smallest integer
    every = F.hash(*columns) >= -(1 << 31)
    rows = parsed.filter(F.col(REJECT).isNull() & every).select(*columns)
    rejects = parsed.filter(F.col(REJECT).isNotNull() & every).select(F.col(REJECT).alias("line"))
    return rows, rejects


def inline(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small literal table with a DDL schema, e.g. ``"label int, text string"``."""
    return spark.createDataFrame(list(rows), ddl)
