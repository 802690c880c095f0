"""N-Triples over Structured Streaming.

The reference has no streaming code.  The line parser and the triple
statistics are plain column expressions and aggregations without actions, so
the same functions run on a file stream: new N-Triples files dropped into a
folder are parsed incrementally and the per-subject / per-class counts are
kept as streaming aggregation state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ruleweave.operators import triples as T
from ruleweave.sources.ntriples import parse_ntriples


def read_ntriples_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of parsed triples from the text files arriving in ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_ntriples(reader.load(folder))


def subject_counts_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Running triples-per-subject counts (use output mode ``complete`` or ``update``)."""
    return T.subject_counts(read_ntriples_stream(spark, folder))


def class_counts_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Running instances-per-class counts."""
    return T.class_counts(read_ntriples_stream(spark, folder))
