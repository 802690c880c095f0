"""Triple statistics over the parsed triple table ``<s, p, o, s_kind, o_kind, ...>``.

All counts are hash aggregations with map-side partial aggregation, so a hot
subject or class costs one partial row per map task; top-k uses
``orderBy().limit()`` (``TakeOrderedAndProject``, no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.functions.iri import RDF_TYPE
from ruleweave.sources.ntriples import TRIPLE_COLUMNS, classify_lines


def line_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row: total lines and lines per kind (comment, blank, triple, malformed)."""
    k = F.col("line_kind")
    return classify_lines(lines, col).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(k == "comment").alias("n_comment"),
        F.count_if(k == "blank").alias("n_blank"),
        F.count_if(k == "triple").alias("n_triples"),
        F.count_if(k == "malformed").alias("n_malformed"),
    )


def preview(triples: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` triples in a total order (s, p, o)."""
    return triples.orderBy("s", "p", "o", "o_lang", "o_datatype").limit(n)


def type_triples(triples: DataFrame, predicate_contains: str | None = None,
                 object_prefix: str | None = "http") -> DataFrame:
    """Class-membership triples: predicate = rdf:type (or contains a string),
    IRI object (optionally with a prefix)."""
    p = F.col("p")
    cond = p.contains(predicate_contains) if predicate_contains else (p == RDF_TYPE)
    cond = cond & (F.col("o_kind") == "iri")
    if object_prefix:
        cond = cond & F.col("o").startswith(object_prefix)
    return triples.filter(cond)


def by_predicate(triples: DataFrame, predicate_contains: str, object_prefix: str | None = None) -> DataFrame:
    cond = F.col("p").contains(predicate_contains)
    if object_prefix:
        cond = cond & F.col("o").startswith(object_prefix)
    return triples.filter(cond).select(*TRIPLE_COLUMNS)


def subject_counts(triples: DataFrame) -> DataFrame:
    """Triples per subject."""
    return triples.groupBy("s").agg(F.count(F.lit(1)).alias("n"))


def class_counts(triples: DataFrame) -> DataFrame:
    """Instances per class (object of the type triples)."""
    return type_triples(triples).groupBy(F.col("o").alias("class")).agg(F.count(F.lit(1)).alias("n"))


def types_per_subject(triples: DataFrame) -> DataFrame:
    return type_triples(triples).groupBy("s").agg(F.count(F.lit(1)).alias("n"))


def top_by_count(counts: DataFrame, key: str, k: int = 5) -> DataFrame:
    """Top-k rows by ``n`` (ties broken by the key)."""
    return counts.orderBy(F.col("n").desc(), F.col(key).asc()).limit(k)


def distinct_terms(triples: DataFrame) -> DataFrame:
    """Distinct terms over subject ∪ object (``term``)."""
    return triples.select(F.explode(F.array("s", "o")).alias("term")).distinct()
