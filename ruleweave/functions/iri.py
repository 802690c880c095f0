"""Column functions over IRIs and RDF terms (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed vocabulary IRIs (W3C RDF / RDFS / XSD namespaces).
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS_SUBCLASS_OF = "http://www.w3.org/2000/01/rdf-schema#subClassOf"
XSD = "http://www.w3.org/2001/XMLSchema#"


def local_name(c: Column | str) -> Column:
    """Part after the last ``#`` (the whole string when there is none)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substring_index(c, "#", -1)


def contains(c: Column | str, needle: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.contains(needle)


def starts_with(c: Column | str, prefix: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.startswith(prefix)
