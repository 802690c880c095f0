"""Taxonomy (``subClassOf`` hierarchy) operators.

A taxonomy set is one long table ``edges<k int, child string, parent string>``
(``k`` = ontology id), so every operator handles all ontologies in one plan.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.functions.iri import RDFS_SUBCLASS_OF, local_name
from ruleweave.operators.intervals import descendants_in, interval_labels
from ruleweave.operators.sizing import DEFAULT_BROADCAST_ROWS, cut_lineage, fits, materialize, materialize_sized
from ruleweave.operators.skew import lookup_join_many


def subclass_edges(triples: DataFrame, predicate_contains: str | None = None) -> DataFrame:
    """Edges ``<k, child, parent>`` (local names) from parsed triples with a ``k`` column.

    By default the predicate must equal ``rdfs:subClassOf``; pass
    ``predicate_contains="subClassOf"`` for the looser substring test.
    """
    p = F.col("p")
    cond = p.contains(predicate_contains) if predicate_contains else (p == RDFS_SUBCLASS_OF)
    return (
        triples.filter(cond & (F.col("o_kind") == "iri"))
        .select(F.col("k").cast("int").alias("k"), local_name("s").alias("child"),
                local_name("o").alias("parent"))
        .distinct()
    )


def concepts(edges: DataFrame) -> DataFrame:
    """Concept universe per ontology: children ∪ parents, distinct."""
    return (
        edges.select("k", F.explode(F.array("child", "parent")).alias("concept"))
        .distinct()
    )


def children(edges: DataFrame) -> DataFrame:
    """Direct children per concept in long form ``<k, parent, child, n_children>``.

    One row per (parent, child): a parent with millions of children is never
    gathered into one row; ``n_children`` comes from a partial aggregation and
    a skew-safe lookup join back to the edges.
    """
    e = cut_lineage(edges.select("k", "parent", "child").distinct())
    # written once: its size decides the join
    counts, n, size = materialize_sized(e.groupBy("k", "parent").agg(F.count(F.lit(1)).alias("n_children")))
    return lookup_join_many(e, counts, ["k", "parent"], lookup_small=fits(n, size))


def children_of(edges: DataFrame, k: int, concept: str) -> DataFrame:
    """Direct children of one concept (the parent-lookup step)."""
    return edges.filter((F.col("k") == k) & (F.col("parent") == concept)).select("child")


def inner_closure(edges: DataFrame, max_rounds: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges and inner concepts ``<k, child>``, both written, and the closure of the edges between inner concepts.

    Leaves (concepts without children, usually nearly all) can only end a path,
    so the fixpoint runs over the inner edges alone: path doubling, where each
    round appends all known pairs to the pairs the last round found, keeps the
    shortest depth per pair and drops known pairs (``left_anti``); about
    log2(depth) rounds, and it terminates on cycles and DAGs.  Each round is
    written to the shared folder; the write observes its row count, the stop test.
    A given ``max_rounds`` that is not enough raises.
    """
    # the edges are read once (their source may be an expensive parse)
    edges = cut_lineage(edges.select("k", "child", "parent").distinct())
    parents, n_parents = materialize(edges.select("k", F.col("parent").alias("child")).distinct())
    as_pair = ["k", F.col("parent").alias("anc"), F.col("child").alias("leaf"), F.lit(1).alias("depth")]
    side = F.broadcast(parents) if n_parents <= DEFAULT_BROADCAST_ROWS else parents
    pairs, n_new = materialize(edges.join(side, ["k", "child"], "left_semi").select(*as_pair))
    fresh = pairs
    for rnd in itertools.count():
        if n_new == 0:
            break
        if max_rounds is not None and rnd > max_rounds:
            raise RuntimeError(f"the closure is not done after {max_rounds} rounds")
        left = fresh.select("k", "anc", F.col("leaf").alias("_mid"), F.col("depth").alias("_d1"))
        right = pairs.select("k", F.col("anc").alias("_mid"), "leaf", F.col("depth").alias("_d2"))
        longer = (
            left.join(right, ["k", "_mid"])
            .groupBy("k", "anc", "leaf").agg(F.min(F.col("_d1") + F.col("_d2")).alias("depth"))
            .join(pairs.select("k", "anc", "leaf"), ["k", "anc", "leaf"], "left_anti")
        )
        fresh, n_new = materialize(longer)
        # a union of written pieces: lineage stays shallow without a rewrite, and file sizes tell the planner what to broadcast
        pairs = pairs.unionByName(fresh)
    return edges, side, pairs


def closure(edges: DataFrame, include_self: bool = False, max_rounds: int | None = None) -> DataFrame:
    """Transitive closure ``<k, anc, leaf, depth>`` (``depth`` = shortest path length).

    The fixpoint runs over inner concepts (:func:`inner_closure`); leaves then take their
    parents' ancestors by one skew-safe lookup (a parent may hold a third of all leaves).
    """
    edges, parents, pairs = inner_closure(edges, max_rounds)
    # a leaf of several parents takes the shortest path of each ancestor; one of a single parent has no second path
    n_parents = edges.groupBy("k", "child").agg(F.count(F.lit(1)).alias("_np"), F.min("parent").alias("parent"))
    leaves = n_parents.join(parents, ["k", "child"], "left_anti")
    above, n, size = materialize_sized(
        pairs.groupBy("k", F.col("leaf").alias("parent")).agg(F.collect_list(F.struct("anc", "depth")).alias("_up")))
    one = F.array(F.struct(F.col("parent").alias("anc"), F.lit(0).alias("depth")))

    def up(rows: DataFrame) -> DataFrame:
        return lookup_join_many(rows, above, ["k", "parent"], how="left", lookup_small=fits(n, size)).select(
            "k", F.col("child").alias("leaf"), F.explode(F.concat(one, F.coalesce("_up", F.slice(one, 1, 0)))).alias("_u"))

    single = up(leaves.filter("_np = 1").select("k", "child", "parent")).select("k", "_u.anc", "leaf", (F.col("_u.depth") + 1).alias("depth"))
    several = edges.join(leaves.filter("_np > 1").select("k", "child"), ["k", "child"], "left_semi")
    several = up(several).groupBy("k", F.col("_u.anc").alias("anc"), "leaf").agg((F.min("_u.depth") + 1).alias("depth"))
    pairs = pairs.unionByName(single).unionByName(several)
    if include_self:
        selfs = concepts(edges).select("k", F.col("concept").alias("anc"), F.col("concept").alias("leaf"),
                                       F.lit(0).alias("depth"))
        pairs = pairs.unionByName(selfs)
    return pairs


def descendants_of(closure_df: DataFrame, k: int, concept: str) -> DataFrame:
    """All strict descendants of one concept (lookup in the closure)."""
    return closure_df.filter((F.col("k") == k) & (F.col("anc") == concept) & (F.col("depth") > 0)).select("leaf")


def descendants(edges: DataFrame, k: int, concept: str) -> DataFrame:
    """``<leaf>``: all strict descendants of one concept.

    In a forest they are the concept's interval (:func:`~ruleweave.operators.intervals.interval_labels`), without a closure.  If
    the forest leaves edges out (several parents, cycles), the concepts below are found round by round from the
    concept itself, so only its own part of the taxonomy is read again.
    """
    mine = cut_lineage(edges.filter(F.col("k") == k).select("k", "child", "parent").distinct())
    labels, left_out = interval_labels(mine)
    if not left_out:
        return descendants_in(labels, k, concept)
    fresh = found = cut_lineage(mine.filter(F.col("parent") == concept).select("child").distinct())
    while True:
        below = mine.join(fresh.withColumnRenamed("child", "parent"), "parent").select("child").distinct()
        fresh, n = materialize(below.join(found, "child", "left_anti"))
        if not n:
            return found.select(F.col("child").alias("leaf"))
        found = found.unionByName(fresh)


def ancestor_sets(edges: DataFrame, top: str = "Thing", closure_df: DataFrame | None = None) -> DataFrame:
    """``<k, value, ancs array<string>>``: ancestors-or-self of every concept under ``top``.

    Each array holds the ancestors of one concept, so its size is bounded by the
    taxonomy's depth (by the ancestor count in a DAG), not by the data.

    Only concepts reachable from ``top`` take part (a concept outside the tree
    of ``top`` is never reached by a general-to-specific search).  The table is
    small (concepts x depth) and is materialised once in the checkpoint folder.
    """
    if closure_df is not None:
        under_top = closure_df.filter(F.col("anc") == top).select("k", F.col("leaf").alias("value"))
        pairs = closure_df.join(under_top.withColumnRenamed("value", "anc"), ["k", "anc"], "left_semi")
        return cut_lineage(
            pairs.join(under_top.withColumnRenamed("value", "leaf"), ["k", "leaf"], "left_semi")
            .groupBy("k", F.col("leaf").alias("value"))
            .agg(F.sort_array(F.collect_set("anc")).alias("ancs"))
        )
    edges, parents, pairs = inner_closure(edges)
    selfs = parents.select("k", F.col("child").alias("anc"), F.col("child").alias("leaf"))
    inner = (pairs.select("k", "anc", "leaf").unionByName(selfs).groupBy("k", F.col("leaf").alias("parent"))
             .agg(F.collect_set("anc").alias("_all")).filter(F.array_contains("_all", top)))
    # of an inner concept's ancestors those under the top, which are the ones that have a row here
    ups = inner.select("k", F.col("parent").alias("_p"), F.explode("_all").alias("parent"))
    inner, n, size = materialize_sized(
        ups.join(inner.select("k", "parent"), ["k", "parent"], "left_semi").groupBy("k", F.col("_p").alias("parent"))
        .agg(F.sort_array(F.collect_set("parent")).alias("ancs")))
    leaves = edges.join(parents, ["k", "child"], "left_anti")
    led = lookup_join_many(leaves, inner, ["k", "parent"], lookup_small=fits(n, size))
    # a leaf of several parents has the ancestors of each
    led = led.groupBy("k", F.col("child").alias("value")).agg(F.array_distinct(F.flatten(F.collect_list("ancs"))).alias("ancs"))
    own = F.array_append("ancs", F.col("value"))
    top_leaf = edges.filter(F.col("child") == top).join(parents, ["k", "child"], "left_anti").select("k", F.col("child").alias("value")).distinct()
    led = led.select("k", "value", F.sort_array(own).alias("ancs")).filter(F.col("value") != top).unionByName(
        top_leaf.select("k", "value", F.array("value").alias("ancs")))
    return cut_lineage(inner.select("k", F.col("parent").alias("value"), "ancs").unionByName(led))


def uri_dictionary(triples: DataFrame) -> DataFrame:
    """``<uri, local_name>`` over all IRI subjects and objects."""
    terms = triples.select(
        F.explode(F.array(
            F.when(F.col("s_kind") == "iri", F.col("s")),
            F.when(F.col("o_kind") == "iri", F.col("o")),
        )).alias("uri")
    ).filter(F.col("uri").isNotNull()).distinct()
    return terms.select("uri", local_name("uri").alias("local_name"))
