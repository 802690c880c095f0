"""Property graph over DataFrames: ``vertices<id bigint, label string>`` and
``edges<src bigint, dst bigint, attr string>`` (a multigraph: parallel edges stay).

Iterative operators (components, PageRank) run one small convergence job per
round and checkpoint their state to the shared checkpoint folder, so the
lineage never grows and a lost executor recomputes at most one round.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.functions.numeric import grid_round
from ruleweave.operators.sizing import DEFAULT_BROADCAST_ROWS, cut_lineage, is_small, materialize, materialize_sized
from ruleweave.operators.skew import DEFAULT_CHUNK_ROWS, hot_keys, lookup_join
from ruleweave.session import ensure_checkpoint_dir

# Bytes of weighted edges in one partition of a graph too large to broadcast its ranks.
EDGE_PARTITION_BYTES = 128 << 20


def dictionary_encode(terms: DataFrame, col: str = "label", num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``0..n-1`` in label order: ``<id bigint, label string>``.

    Range-partition the distinct labels and sort inside each range; the range's
    number and the position inside it become columns before anything is written,
    so ids do not depend on how files are read back.  An id is the range's
    offset plus the position; offsets come from per-range counts (one row per
    range, broadcast).  No global single-partition window over the labels.
    """
    labels = terms.select(F.col(col).alias("label")).filter(F.col("label").isNotNull()).distinct()
    # without a fixed count AQE sizes the ranges from the data
    ranged = labels.repartitionByRange(num_partitions, "label") if num_partitions else labels.repartitionByRange("label")
    pos = cut_lineage(ranged.sortWithinPartitions("label").select(
        "label",
        F.spark_partition_id().alias("_pid"),
        # monotonically_increasing_id = (partition << 33) + row position
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias("_pos"),
    ))
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
    )
    return pos.join(F.broadcast(offsets), "_pid").select((F.col("_off") + F.col("_pos")).alias("id"), "label")


def build_graph(triples: DataFrame, s: str = "s", p: str = "p", o: str = "o") -> tuple[DataFrame, DataFrame]:
    """Vertices = distinct terms over subject ∪ object; one edge per triple."""
    terms = triples.select(F.explode(F.array(F.col(s), F.col(o))).alias("label"))
    vertices = cut_lineage(dictionary_encode(terms))
    return vertices, edges_from_triples(triples, vertices, s, p, o)


def edges_from_triples(triples: DataFrame, vertices: DataFrame, s: str = "s", p: str = "p",
                       o: str = "o") -> DataFrame:
    """``<src, dst, attr>``: subject and object looked up in the vertex dictionary.

    Both lookups are skew-safe joins: broadcast when the dictionary is small,
    otherwise hot terms (say a class IRI that every type triple points to)
    are split over several partitions; one pass over the triples counts them for both.
    """
    v = vertices.select(F.col("id"), F.col("label"))
    small = is_small(v)
    vs = v.select(F.col("label").alias("_sl"), F.col("id").alias("src"))
    vo = v.select(F.col("label").alias("_ol"), F.col("id").alias("dst"))
    t = triples.select(F.col(s).alias("_s"), F.col(p).alias("attr"), F.col(o).alias("_o"))
    hot = {c: None for c in ("_s", "_o")}
    if not small:
        counted = hot_keys(t, list(hot))
        hot = {c: counted.filter(F.col("column") == c).select("_hk", "_ns") for c in hot}
    with_src = lookup_join(t, vs, "_s", "_sl", lookup_small=small, hot=hot["_s"])
    return lookup_join(with_src, vo, "_o", "_ol", lookup_small=small, hot=hot["_o"]).select("src", "dst", "attr")


def subgraph(edges: DataFrame, attr: str) -> DataFrame:
    """Edges whose attribute equals ``attr``; all vertices stay."""
    return edges.filter(F.col("attr") == attr)


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))


def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int | None = None,
                         broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                         chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``<id, component>`` with component = smallest vertex id of the component.

    Hook and contract: every round each vertex with a smaller neighbour hooks to
    its smallest one (one ``groupBy(min)`` over the pairs' larger ends, partial
    aggregation absorbs hubs), two pointer jumps shorten the chains, and the
    edges are contracted to the distinct pairs of new labels.  Vertices that do not hook
    keep their label and are in no map.  So a round reads
    only vertices and edges of the contracted graph, which shrinks.  A component's
    smallest vertex never hooks, so it names the component once no edge is left.
    The rounds' label maps are then joined from the last one back, and every
    vertex is looked up once.  All lookups are skew-safe joins: broadcast when the
    label count is small, else hub vertices and giant labels are split over
    several partitions.  Edges are undirected and their ends must be in
    ``vertices``.  A given ``max_rounds`` that is not enough raises.
    """
    kw = dict(chunk_rows=chunk_rows, broadcast_rows=broadcast_rows)
    e, n_e = materialize(_contracted(edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))))
    maps: list[tuple[DataFrame, int]] = []
    while n_e:
        if max_rounds is not None and len(maps) > max_rounds:
            raise RuntimeError(f"components are not done after {max_rounds} rounds")
        # a < b: a vertex hooks only where it is a pair's larger end
        hook, n_ids = materialize(e.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("comp"), F.count(F.lit(1)).alias("_n")))
        hot = hook.filter(F.col("_n") > chunk_rows).select(
            F.col("id").alias("_hk"), F.ceil(F.col("_n") / F.lit(chunk_rows)).cast("int").alias("_ns"))
        label, small = hook.drop("_n"), n_ids <= broadcast_rows
        for _ in range(2):
            label = cut_lineage(_relabel(label, label, small, **kw))
        maps.append((label, n_ids))
        for end, found in (("a", None), ("b", hot)):
            side = label.select(F.col("id").alias("_i"), F.col("comp").alias(f"_{end}"))
            e = lookup_join(e, side, end, "_i", how="left", lookup_small=small, hot=found, **kw)
        e = e.select(F.coalesce("_a", "a").alias("_a"), F.col("_b"))
        e, n_e = materialize(_contracted(e.select(F.col("_a").alias("a"), F.col("_b").alias("b"))))
    last, n_last = None, 0
    for label, n_ids in reversed(maps):
        # a label without edges in the later rounds is final; one that hooks in a later round only comes from there
        if last is not None:
            both = _relabel(label, last, n_last <= broadcast_rows, **kw).unionByName(last)
            label = cut_lineage(both.groupBy("id").agg(F.min("comp").alias("comp")))
        last, n_last = label, n_ids + n_last
    ids = vertices.select("id", F.col("id").alias("comp"))
    out = ids if last is None else _relabel(ids, last, n_last <= broadcast_rows, **kw)
    return out.select("id", F.col("comp").alias("component"))


def _contracted(pairs: DataFrame) -> DataFrame:
    """Distinct undirected pairs ``a < b``."""
    return (pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .filter(F.col("a") != F.col("b")).distinct())


def _relabel(labels: DataFrame, later: DataFrame, small: bool, **kw) -> DataFrame:
    """comp <- later(comp) where ``later`` lists it."""
    side = later.select(F.col("id").alias("_pid"), F.col("comp").alias("_pc"))
    out = lookup_join(labels, side, "comp", "_pid", how="left", lookup_small=small, **kw)
    return out.select("id", F.coalesce("_pc", "comp").alias("comp"))


def _weighted_edges(edges: DataFrame, broadcast_rows: int, chunk_rows: int) -> tuple[DataFrame, DataFrame, int, int]:
    """Parallel edges merged into ``weight = multiplicity / out_degree(src)``, the sources ``<id, _d, _n>`` with their
    out-degree and distinct targets, the number of sources and the bytes of the weighted edges.

    The merged edges are written before they are counted, so the given edges are computed once.
    """
    mult = cut_lineage(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_m")))
    sources, n_sources = materialize(mult.groupBy(F.col("src").alias("id")).agg(F.sum("_m").alias("_d"), F.count(F.lit(1)).alias("_n")))
    deg = sources.select(F.col("id").alias("_ds"), "_d")
    met = lookup_join(mult, deg, "src", "_ds", lookup_small=n_sources <= broadcast_rows, hot=_hot_sources(sources, chunk_rows))
    weighted, _, size = materialize_sized(met.select("src", "dst", (F.col("_m") / F.col("_d")).alias("w")))
    return weighted, sources, n_sources, size


def _hot_sources(sources: DataFrame, chunk_rows: int) -> DataFrame:
    """``<_hk, _ns>``: sources with more than ``chunk_rows`` distinct targets and their salts."""
    return sources.filter(F.col("_n") > chunk_rows).select(
        F.col("id").alias("_hk"), F.ceil(F.col("_n") / F.lit(chunk_rows)).cast("int").alias("_ns"))


class _EdgeSender:
    """Sends values along weighted out-edges.

    Values of at most ``broadcast_rows`` vertices are broadcast, so the edges do not move.  The first time there are more, the
    edges are persisted hash partitioned by ``(src, salt)`` and sorted, in as many partitions as their size asks for: a source with
    more than ``chunk_rows`` out-edges gets several salts and its value is replicated per salt, so from then on only values move.
    """

    def __init__(self, edges: DataFrame, broadcast_rows: int, chunk_rows: int):
        self.spark, self.broadcast_rows, self.chunk_rows = edges.sparkSession, broadcast_rows, chunk_rows
        self.weighted, self.sources, self.n_sources, self.size = _weighted_edges(edges, broadcast_rows, chunk_rows)
        self.salted = None

    def _dealt(self) -> DataFrame:
        if self.salted is None:
            self.parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-self.size // EDGE_PARTITION_BYTES))
            hot, n_hot = materialize(_hot_sources(self.sources, self.chunk_rows))
            self.hot = F.broadcast(hot) if n_hot <= self.broadcast_rows else hot
            w = self.weighted.join(self.hot, F.col("src") == F.col("_hk"), "left").select(
                "src", "dst", "w", F.pmod(F.xxhash64("dst"), F.coalesce(F.col("_ns"), F.lit(1))).cast("int").alias("_salt"))
            # kept in memory or on disk with its partitioning; a lost block is made again from the written table
            self.salted = w.repartition(self.parts, "src", "_salt").sortWithinPartitions("src", "_salt").persist(StorageLevel.MEMORY_AND_DISK)
        return self.salted

    def send(self, values: DataFrame, n: int) -> DataFrame:
        """``<id, _c>`` of ``values <id, value>`` of ``n`` vertices: every value times the weights of its vertex's out-edges."""
        side = values.select(F.col("id").alias("src"), "value")
        if min(n, self.n_sources) <= self.broadcast_rows:
            if n > self.broadcast_rows:
                side = side.join(F.broadcast(self.sources.select(F.col("id").alias("src"))), "src", "left_semi")
            met = self.weighted.join(F.broadcast(side), "src")
        else:
            w = self._dealt()
            side = side.join(self.hot, F.col("src") == F.col("_hk"), "left").select(
                "src", "value", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ns"), F.lit(1)) - 1)).alias("_salt"))
            met = w.join(side.repartition(self.parts, "src", "_salt"), ["src", "_salt"])
        return met.select(F.col("dst").alias("id"), (F.col("value") * F.col("w")).alias("_c"))

    def release(self) -> None:
        if self.salted is not None:
            self.salted.unpersist()


def pagerank(vertices: DataFrame, edges: DataFrame, reset: float = 0.15, max_iter: int = 20,
             tol: float | None = None, normalize: bool = False,
             broadcast_rows: int = DEFAULT_BROADCAST_ROWS, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``<id, rank>``: ``rank = reset + (1-reset) * Σ rank(src) * mult / outdeg(src)``.

    Without a tolerance: ``max_iter`` rounds from 1.0.  With ``tol``: until no vertex holds a residual above it
    (:func:`residual_rounds`), which raises if ``max_iter`` rounds do not suffice.
    ``normalize`` rescales the ranks to sum to the vertex count (mass lost in
    sinks is restored).

    Parallel edges are merged into weights once and checkpointed.  The ``max_iter`` rounds are those of :func:`walk_rounds`.
    Edges' ends must be in ``vertices``.
    """
    if tol is not None:
        rounds = residual_rounds(vertices, edges, tol, reset, max_iter, broadcast_rows, chunk_rows)
        # what a vertex has sent, and what it holds at the end
        ranks = cut_lineage(rounds.filter((F.col("residual") > tol) | (F.col("round") == F.col("last")))
                            .groupBy("id").agg(F.sum("residual").alias("rank")))
    else:
        ids = vertices.select("id")
        parts = ids.withColumn("part", F.lit(reset if max_iter else 1.0))
        if max_iter:
            walks = walk_rounds(edges, reset, max_iter, broadcast_rows, chunk_rows)
            parts = parts.unionByName(walks.select("id", (F.col("value") * F.when(F.col("round") == max_iter, 1.0).otherwise(reset)).alias("part")))
        ranks = cut_lineage(parts.groupBy("id").agg(F.sum("part").alias("rank")))
    if normalize:
        n = ranks.select(F.count(F.lit(1)).cast("double")).scalar()
        total = ranks.select(F.sum("rank")).scalar()
        ranks = ranks.select("id", (F.col("rank") * n / total).alias("rank"))
    return ranks


def walk_rounds(edges: DataFrame, reset: float = 0.15, max_iter: int = 20, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``<round, id, value, sends>`` for the rounds ``k`` from 1 to ``max_iter``: what arrives by walks of ``k`` edges.

    A vertex's value of round 0 is 1; in every round vertices with out-edges send ``(1-reset) * value * weight`` along them.
    Unrolled, the rank after ``max_iter`` rounds is ``reset`` times the values of the rounds before the last plus
    the last one's value, so no round rewrites ranks.  A round is written once, holds only vertices that a walk of its length
    ends at, and its write counts the senders (``sends``); without any, longer walks do not exist and their rounds are empty.
    """
    spark = edges.sparkSession
    base = f"{ensure_checkpoint_dir(spark)}/walks-{uuid.uuid4().hex}"
    sender = _EdgeSender(edges, broadcast_rows, chunk_rows)
    goes_on = sender.sources.select(F.col("id").alias("_src"))
    goes_on = F.broadcast(goes_on) if sender.n_sources <= broadcast_rows else goes_on
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("sends", T.BooleanType())])
    sent = sender.weighted.select(F.col("dst").alias("id"), F.col("w").alias("_c"))  # every value is 1
    for i in range(1, max_iter + 1):
        seen, path = Observation(), f"{base}/round={i}"
        arrived = sent.groupBy("id").agg((F.lit(1.0 - reset) * F.sum("_c")).alias("value"))
        (arrived.join(goes_on, F.col("id") == F.col("_src"), "left").select("id", "value", F.col("_src").isNotNull().alias("sends"))
         .observe(seen, F.count_if(F.col("sends")).alias("senders")).write.parquet(path))
        values = spark.read.schema(schema).parquet(path).filter("sends")
        # a plan known to be empty may drop the observation
        senders = seen.get["senders"] if "senders" in seen.get else values.count()
        if senders == 0:
            break
        sent = sender.send(values, senders)
    sender.release()
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("round", T.IntegerType())])).parquet(base)


def residual_rounds(vertices: DataFrame, edges: DataFrame, tol: float, reset: float = 0.15, max_iter: int = 1000,
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """The rounds of a PageRank in which only vertices with news send: ``<round, id, residual, last>``.

    Every vertex starts with the residual ``reset``.  In a round those whose residual exceeds ``tol`` send
    ``(1-reset) * residual * weight`` along their out-edges and keep nothing; the others keep theirs and add what arrives.
    It ends with the round ``last`` in which none exceeds ``tol``.  A vertex's rank is all it ever sent plus what it still
    holds; over all vertices the ranks miss at most ``n * tol * (1-reset) / reset`` of the exact ones.

    A round is written once, holds only vertices with a residual, and its write counts the senders, so a round costs what the
    senders' edges cost and no round rewrites ranks.  Senders that fit are broadcast: the edges then stay where they are,
    however large the graph.  No vertices give no rows.
    """
    if tol <= 0:
        raise ValueError("tol must be positive")
    spark = vertices.sparkSession
    base = f"{ensure_checkpoint_dir(spark)}/residuals-{uuid.uuid4().hex}"
    ids = cut_lineage(vertices.select("id"))
    sender = _EdgeSender(edges, broadcast_rows, chunk_rows)
    held = ids.select("id", F.lit(reset).cast("double").alias("residual"))
    schema = held.schema
    for i in range(max_iter + 1):
        seen = Observation()
        path = f"{base}/round={i}"
        held.observe(seen, F.count_if(F.col("residual") > tol).alias("senders")).write.parquet(path)
        held = spark.read.schema(schema).parquet(path)
        # a plan known to be empty may drop the observation
        senders = seen.get["senders"] if "senders" in seen.get else held.filter(F.col("residual") > tol).count()
        if senders == 0:
            break
        if i == max_iter:
            raise RuntimeError(f"{senders} vertices still hold more than {tol} after {max_iter} rounds")
        sent = sender.send(held.filter(F.col("residual") > tol).select("id", F.col("residual").alias("value")), senders)
        kept = held.filter(F.col("residual") <= tol)
        arrived = sent.select("id", (F.col("_c") * F.lit(1.0 - reset)).alias("residual"))
        held = arrived.unionByName(kept).groupBy("id").agg(F.sum("residual").alias("residual"))
    sender.release()
    rounds = spark.read.schema(T.StructType([*schema.fields, T.StructField("round", T.IntegerType())])).parquet(base)
    return rounds.select("round", "id", "residual", F.lit(i).alias("last"))


def ranked_vertices(ranks: DataFrame, vertices: DataFrame, k: int = 5, bits: int = 20) -> DataFrame:
    """Top-k vertices by rank (rounded to a 2**-bits grid), ties by label: ``<id, label, rank>``."""
    r = ranks.join(vertices, "id").select("id", "label", grid_round("rank", bits).alias("rank"))
    return r.orderBy(F.col("rank").desc(), F.col("label").asc()).limit(k)
