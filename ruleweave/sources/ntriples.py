"""N-Triples: raw line scan, comment filter and a column-wise line parser.

The parser follows the W3C N-Triples line grammar with one regular expression,
evaluated once per line on the JVM (``regexp_replace`` + ``split``); no Python
touches a row.  Output schema::

    s, p, o, s_kind, o_kind, o_lang, o_datatype : string

``*_kind`` is ``iri`` / ``bnode`` / ``literal``; IRIs lose their angle
brackets, blank nodes keep ``_:``, literals are unescaped.  Lines that do not
match (junk, truncated triples) are flagged by :func:`classify_lines` and
dropped by :func:`parse_ntriples`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Term patterns of the N-Triples grammar.  Plain characters are taken in possessive
# runs, so long terms neither recurse nor backtrack.
_UCHAR = r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}"
_IRI_CHARS = r'[^\x00-\x20<>"{}|^`\\]*+'
_IRI_BODY = rf"{_IRI_CHARS}(?:(?:{_UCHAR}){_IRI_CHARS})*+"
_IRI = rf"<({_IRI_BODY})>"
_LABEL = r"\p{L}\p{N}_:"
_BNODE = rf"(_:[{_LABEL}](?:[{_LABEL}\-\u00b7\p{{M}}]|\.+(?=[{_LABEL}\-\u00b7\p{{M}}]))*+)"
_TEXT_CHARS = r'[^"\\\n\r]*+'
_LITERAL = (rf'"({_TEXT_CHARS}(?:(?:\\[tbnrf"\'\\]|{_UCHAR}){_TEXT_CHARS})*+)"'
            rf"(?:@([A-Za-z]+(?:-[A-Za-z0-9]+)*+)|\^\^<({_IRI_BODY})>)?")

# Groups: 1 subject IRI, 2 subject bnode, 3 predicate IRI, 4 object IRI,
# 5 object bnode, 6 literal body, 7 language tag, 8 datatype IRI.
LINE_PATTERN = (
    r"^[ \t]*(?:" + _IRI + "|" + _BNODE + r")[ \t]*" + _IRI + r"[ \t]*(?:"
    + _IRI + "|" + _BNODE + "|" + _LITERAL + r")[ \t]*\.[ \t]*(?:#.*)?$"
)

TRIPLE_COLUMNS = ["s", "p", "o", "s_kind", "o_kind", "o_lang", "o_datatype"]


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw line scan (one row per line, column ``value``)."""
    return spark.read.text(list(paths))


def without_comments(lines: DataFrame, col: str = "value") -> DataFrame:
    """Drop comment lines (``#`` first non-blank) and blank lines."""
    t = F.btrim(F.col(col), F.lit(" \t"))
    return lines.filter(~t.startswith("#") & (t != ""))


def _unescape(body: Column) -> Column:
    """Decode string and IRI escapes (the grammar admits only valid ones).

    All but ``\\UXXXXXXXX`` and ``\\'`` are JSON's, so rows holding a backslash are decoded
    by the JVM JSON reader; the eight-digit form is first rewritten to four-digit
    ones (a surrogate pair beyond the basic plane).  Other rows pass unchanged.
    """
    def wide(unit: Column) -> Column:
        code = F.conv(F.substr(unit, F.lit(3)), 16, 10).cast("long")
        short = F.concat(F.lit("\\u"), F.substr(unit, F.lit(7)))
        pair = F.concat(F.lit("\\u"), F.hex(F.lit(0xD800) + F.shiftright(code - 0x10000, 10)),
                        F.lit("\\u"), F.hex(F.lit(0xDC00) + (code - 0x10000).bitwiseAND(0x3FF)))
        return F.when(code < 0x10000, short).otherwise(pair)

    units = F.regexp_extract_all(body, F.lit(r"(\\U[0-9A-Fa-f]{8}|\\.|[^\\]+)"), F.lit(1))
    narrow = F.array_join(F.transform(units, lambda u: F.when(u.startswith("\\U"), wide(u)).otherwise(u)), "")
    json = F.when(body.contains("\\U"), narrow).otherwise(body)
    decoded = F.from_json(
        F.concat(F.lit('["'), json, F.lit('"]')),
        "array<string>",
        {"allowBackslashEscapingAnyCharacter": "true", "allowUnquotedControlChars": "true"},
    )[0]
    return F.when(body.contains("\\"), decoded).otherwise(body)


def classify_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Add ``line_kind``: ``comment``, ``blank``, ``triple`` or ``malformed``."""
    v = F.col(col)
    t = F.btrim(v, F.lit(" \t"))
    return lines.withColumn(
        "line_kind",
        F.when(t == "", "blank")
        .when(t.startswith("#"), "comment")
        .when(v.rlike(LINE_PATTERN), "triple")
        .otherwise("malformed"),
    )


_MARK, _SEP = "\u0002", "\u0001"
# The literal body (group 6) is the only group that may hold arbitrary
# characters, so it goes last: a split with limit 8 keeps it whole.
_PACKED_ORDER = [1, 2, 3, 4, 5, 7, 8, 6]
_PACKED = _MARK + _SEP.join(f"${i}" for i in _PACKED_ORDER)


def _groups(packed: Column) -> list[Column]:
    """The 8 capture groups of :data:`LINE_PATTERN` from a rewritten line."""
    parts = F.split(F.substr(packed, F.lit(2)), _SEP, len(_PACKED_ORDER))
    at = {g: i for i, g in enumerate(_PACKED_ORDER)}
    return [F.get(parts, at[g]) for g in range(1, 9)]


def parse_ntriples(lines: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Parse N-Triples lines into the triple schema, then the columns ``keep`` of ``lines``; non-triple lines are dropped.

    One ``regexp_replace`` rewrites a matching line into its groups joined by
    a control character (a non-matching line comes back unchanged) and
    ``split`` cuts them apart.  The rewritten line comes out of a generator, so the
    filter on it cannot be pushed below and the regex runs once per line.
    A line that never matches cannot start with the marker, so the test is exact.
    """
    v = F.col(col)
    packed = F.when(~v.startswith(_MARK), F.regexp_replace(v, LINE_PATTERN, _PACKED))
    g = _groups(F.col("_packed"))
    parsed = (
        lines.select(*keep, F.explode_outer(F.array(packed)).alias("_packed")).filter(F.col("_packed").startswith(_MARK))
        .select(*keep, _unescape(g[0]).alias("_s_iri"), g[1].alias("_s_bn"), _unescape(g[2]).alias("p"), _unescape(g[3]).alias("_o_iri"),
                g[4].alias("_o_bn"), g[5].alias("_lit"), g[6].alias("_lang"), _unescape(g[7]).alias("_dt"))
    )
    s_is_iri = F.col("_s_bn") == ""
    o_kind = (F.when(F.col("_o_iri") != "", "iri")
              .when(F.col("_o_bn") != "", "bnode").otherwise("literal"))
    return parsed.select(
        F.when(s_is_iri, F.col("_s_iri")).otherwise(F.col("_s_bn")).alias("s"),
        F.col("p"),
        F.when(o_kind == "iri", F.col("_o_iri"))
        .when(o_kind == "bnode", F.col("_o_bn"))
        .otherwise(_unescape(F.col("_lit"))).alias("o"),
        F.when(s_is_iri, "iri").otherwise("bnode").alias("s_kind"),
        o_kind.alias("o_kind"),
        F.nullif(F.col("_lang"), F.lit("")).alias("o_lang"),
        F.nullif(F.col("_dt"), F.lit("")).alias("o_datatype"),
        *keep,
    )


def read_ntriples(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_ntriples(read_lines(spark, *paths))


def _place(path: Column) -> Column:
    """A file's address with one slash after the scheme, however many it is written with."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def read_taxonomy_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Multi-source load: one N-Triples file, or folder of files, per ontology; ``k`` = position.

    All files are one scan; a line's ontology follows from the file it was read from (``_metadata.file_path``) by a map of the
    given paths.  A path given twice counts for its first position.
    """
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    places: dict[str, tuple[int, str]] = {}
    for i, p in enumerate(paths):
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        places.setdefault(path.getFileSystem(conf).makeQualified(path).toUri().toString().rstrip("/"), (i, p))
    known = F.create_map(*[x for place, (i, _) in places.items() for x in (_place(F.lit(place)), F.lit(i))])
    file = _place(F.col("_metadata.file_path"))
    k = F.coalesce(F.try_element_at(known, file), F.try_element_at(known, F.regexp_replace(file, "/[^/]*$", "")))
    lines = read_lines(spark, *[p for _, p in places.values()]).select("value", k.alias("k"))
    return parse_ntriples(lines, keep=["k"])
