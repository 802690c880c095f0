"""Bindings from the driver's parquet tables to the operators' inputs.

These functions only shape rows into the schemas the operators expect
(facts, N-Triples lines, documents); all mining, parsing, closure, graph and
text work happens in the operator modules.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.functions.iri import RDF_TYPE, RDFS_SUBCLASS_OF, XSD
from ruleweave.operators.sizing import spread
from ruleweave.session import ensure_checkpoint_dir
from ruleweave.sources.tables import inline

# ---------------------------------------------------------------------------
# Fixed values of the bindings (shared with the oracle SQL).
# ---------------------------------------------------------------------------
TOP = "Thing"
TAXO_NS = ["http://example.org/taxonomy/geo#", "http://example.org/taxonomy/segment#",
           "http://example.org/taxonomy/order#"]
OWL_CLASS = "http://www.w3.org/2002/07/owl#Class"
# taxonomy 0: customer_<c_custkey> -> NATION_i -> region name -> World -> Thing
# (from customer / nation / region, so it grows with the data)
GEO_ROOT = "World"
CUSTOMER_PREFIX = "customer_"
# taxonomy 1: market segments (child, parent)
SEGMENT_EDGES = [
    ("AUTOMOBILE", "Industrial"), ("BUILDING", "Industrial"), ("MACHINERY", "Industrial"),
    ("FURNITURE", "Consumer"), ("HOUSEHOLD", "Consumer"),
    ("Industrial", "Segment"), ("Consumer", "Segment"), ("Segment", TOP),
]
# taxonomy 2 governs two columns: order priority and price band.
# '4-NOT SPECIFIED' and '200k_300k' are deliberately left out of the taxonomy.
ORDER_EDGES = [
    ("1-URGENT", "Expedited"), ("2-HIGH", "Expedited"), ("3-MEDIUM", "Routine"), ("5-LOW", "Routine"),
    ("Expedited", TOP), ("Routine", TOP),
    ("under_100k", "Low"), ("100k_200k", "Low"), ("300k_400k", "High"), ("over_400k", "High"),
    ("Low", TOP), ("High", TOP),
]
# price bands of o_totalprice: (upper bound exclusive, label); the last is open
PRICE_BANDS = [(100000.0, "under_100k"), (200000.0, "100k_200k"), (300000.0, "200k_300k"),
               (400000.0, "300k_400k"), (None, "over_400k")]
FACT_MAPPING = {0: ["customer"], 1: ["segment"], 2: ["priority", "price_band"]}
TARGET_STATUS = "F"

# triple graph vocabulary
BASE = "http://example.org/tpch/"
SCHEMA = "http://example.org/tpch/schema#"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Column-pruned scan of a large table, spread over the cores if it has too few partitions."""
    return spread(table(spark, sf_dir, name).select(*cols))


def price_band(c: Column) -> Column:
    expr = None
    for bound, label in PRICE_BANDS:
        if bound is None:
            expr = expr.otherwise(F.lit(label))
        elif expr is None:
            expr = F.when(c < bound, F.lit(label))
        else:
            expr = expr.when(c < bound, F.lit(label))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(expr)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<id, customer, nation, segment, priority, price_band, target>`` = orders ⋈ customer ⋈ nation."""
    o = scan(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
             "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # dimension joins: broadcast by the planner while the dimension is small; at
    # scale both sides shuffle and AQE splits a hot customer's partition
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey)
        .select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit(CUSTOMER_PREFIX), F.col("c_custkey").cast("string")).alias("customer"),
            F.col("n_name").alias("nation"),
            F.col("c_mktsegment").alias("segment"),
            F.col("o_orderpriority").alias("priority"),
            price_band(F.col("o_totalprice")).alias("price_band"),
            (F.col("o_orderstatus") == TARGET_STATUS).alias("target"),
        )
    )


def _iri(c: Column) -> Column:
    return F.concat(F.lit("<"), c, F.lit(">"))


def _nt(s: Column, p: str, o: Column) -> Column:
    return F.concat_ws(" ", s, F.lit(f"<{p}>"), o, F.lit("."))


def _edge_lines(spark: SparkSession, ns: str, edges: list[tuple[str, str]]) -> DataFrame:
    return _class_lines(inline(spark, edges, "child string, parent string"), ns)


def _class_lines(edges: DataFrame, ns: str, top: str = TOP) -> DataFrame:
    """Per edge a subClassOf line and an owl:Class line for the child; one for the top."""
    child = _iri(F.concat(F.lit(ns), "child"))
    lines = edges.select(F.explode(F.array(
        _nt(child, RDFS_SUBCLASS_OF, _iri(F.concat(F.lit(ns), "parent"))),
        _nt(child, RDF_TYPE, F.lit(f"<{OWL_CLASS}>")),
    )).alias("value"))
    root = edges.sparkSession.range(1).select(_nt(F.lit(f"<{ns}{top}>"), RDF_TYPE, F.lit(f"<{OWL_CLASS}>")).alias("value"))
    return lines.unionByName(root)


def taxonomy_lines(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """One DataFrame of N-Triples lines (``value``) per ontology, index = ontology id."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    c = scan(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    geo_edges = (
        c.join(n, c.c_nationkey == n.n_nationkey).select(
            F.concat(F.lit(CUSTOMER_PREFIX), F.col("c_custkey").cast("string")).alias("child"),
            F.col("n_name").alias("parent"))
        .unionByName(n.join(r, n.n_regionkey == r.r_regionkey)
                     .select(F.col("n_name").alias("child"), F.col("r_name").alias("parent")))
        .unionByName(r.select(F.col("r_name").alias("child"), F.lit(GEO_ROOT).alias("parent")))
        .unionByName(inline(spark, [(GEO_ROOT, TOP)], "child string, parent string"))
    )
    # IRIs may not hold spaces: region names such as 'MIDDLE EAST' use '_' in the IRI
    geo_edges = geo_edges.select(F.regexp_replace("child", " ", "_").alias("child"),
                                 F.regexp_replace("parent", " ", "_").alias("parent"))
    header = spark.createDataFrame([("# taxonomy generated from the nation and region tables",)], "value string")
    return [
        header.unionByName(_class_lines(geo_edges, TAXO_NS[0])),
        _edge_lines(spark, TAXO_NS[1], SEGMENT_EDGES),
        _edge_lines(spark, TAXO_NS[2], ORDER_EDGES),
    ]


def triple_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-Triples text (``value``) describing customers, nations and regions.

    Holds IRI, plain, language-tagged and typed literals, escaped quotes and
    angle brackets inside literals, blank nodes, comment, blank and malformed
    lines, so the parser sees every line shape.
    """
    cust = scan(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    c_iri = _iri(F.concat(F.lit(BASE + "customer/"), F.col("c_custkey").cast("string")))
    n_iri_c = _iri(F.concat(F.lit(BASE + "nation/"), F.col("c_nationkey").cast("string")))
    n_iri = _iri(F.concat(F.lit(BASE + "nation/"), F.col("n_nationkey").cast("string")))
    r_iri_n = _iri(F.concat(F.lit(BASE + "region/"), F.col("n_regionkey").cast("string")))
    r_iri = _iri(F.concat(F.lit(BASE + "region/"), F.col("r_regionkey").cast("string")))

    def lit(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    customer_lines = cust.select(F.explode(F.array(
        _nt(c_iri, RDF_TYPE, F.lit(f"<{SCHEMA}Customer>")),
        _nt(c_iri, SCHEMA + "name", lit(F.col("c_name"))),
        _nt(c_iri, SCHEMA + "inNation", n_iri_c),
        _nt(c_iri, SCHEMA + "segment", F.concat(lit(F.col("c_mktsegment")), F.lit("@en"))),
        _nt(c_iri, SCHEMA + "acctbal", F.concat(lit(F.col("c_acctbal").cast("decimal(15,2)").cast("string")),
                                               F.lit(f"^^<{XSD}decimal>"))),
    )).alias("value"))
    nation_lines = nat.select(F.explode(F.array(
        _nt(n_iri, RDF_TYPE, F.lit(f"<{SCHEMA}Nation>")),
        _nt(n_iri, SCHEMA + "name", lit(F.col("n_name"))),
        _nt(n_iri, SCHEMA + "inRegion", r_iri_n),
        # escaped quotes and angle brackets inside a literal, plus a trailing comment
        F.concat(_nt(n_iri, SCHEMA + "comment",
                     F.concat(F.lit('"nation \\"'), F.col("n_name"), F.lit('\\" <region '),
                              F.col("n_regionkey").cast("string"), F.lit('>"@en'))), F.lit(" # note")),
    )).alias("value"))
    region_lines = reg.select(F.explode(F.array(
        F.concat(F.lit("# region "), F.col("r_name")),
        F.lit(""),
        _nt(r_iri, RDF_TYPE, F.lit(f"<{SCHEMA}Region>")),
        _nt(r_iri, RDF_TYPE, F.lit(f"<{SCHEMA}Place>")),
        _nt(r_iri, SCHEMA + "name", lit(F.col("r_name"))),
        _nt(F.concat(F.lit("_:geo"), F.col("r_regionkey").cast("string")), SCHEMA + "covers", r_iri),
        _nt(r_iri, SCHEMA + "hasArea", F.concat(F.lit("_:area"), F.col("r_regionkey").cast("string"))),
        F.concat(r_iri, F.lit(" <" + SCHEMA + "broken")),
        # escapes in an IRI, an eight-digit escape, a label beyond ASCII, tabs before a comment, an invalid escape
        _nt(_iri(F.concat(F.lit(BASE + "caf\\u00e9/"), F.col("r_regionkey").cast("string"))), SCHEMA + "sign", F.lit('"x\\U0001F600y"')),
        _nt(F.concat(F.lit("_:é:"), F.col("r_regionkey").cast("string")), SCHEMA + "covers", r_iri),
        F.concat(F.lit("\t # note "), F.col("r_name")),
        F.lit("\t"),
        _nt(r_iri, SCHEMA + "sign", F.lit('"bad \\x escape"')),
    )).alias("value"))
    return reduce(DataFrame.unionByName, [customer_lines, nation_lines, region_lines])


def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<s, o, p>`` term pairs supplier -> part from lineitem (one per line item)."""
    li = scan(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey")
    return li.select(
        F.concat(F.lit("supplier/"), F.col("l_suppkey").cast("string")).alias("s"),
        F.lit("supplies").alias("p"),
        F.concat(F.lit("part/"), F.col("l_partkey").cast("string")).alias("o"),
    )


def order_line_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<label>``: terms of orders and their lines from lineitem."""
    li = scan(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    order = F.concat(F.lit("order/"), F.col("l_orderkey").cast("string"))
    return li.select(F.explode(F.array(order, F.concat(order, F.lit("/line/"), F.col("l_linenumber").cast("string")))).alias("label"))


def as_text_files(lines: DataFrame) -> str:
    """Writes ``<value>`` as text files into a new folder beside the checkpoints; its path."""
    path = f"{ensure_checkpoint_dir(lines.sparkSession)}/text-{uuid.uuid4().hex}"
    lines.select("value").write.text(path)
    return path


TSV_COLUMNS = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]
SHORT_EVERY, LONG_EVERY = 50, 70


def customer_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tab-separated lines (``value``); some keys have a second line that lacks fields or has one too many."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    good = F.concat_ws("\t", key, "c_name", "c_mktsegment", F.col("c_acctbal").cast("decimal(15,2)").cast("string"))
    short = F.when(F.col("c_custkey") % SHORT_EVERY == 7, F.concat_ws("\t", F.lit("short"), key))
    long = F.when(F.col("c_custkey") % LONG_EVERY == 3, F.concat_ws("\t", F.lit("long"), key, *[F.lit("x")] * (len(TSV_COLUMNS) - 1)))
    return c.select(F.explode(F.array_compact(F.array(good, short, long))).alias("value"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "documents", "doc_id", "text")


def labeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scan(spark, sf_dir, "documents", "doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label"))
