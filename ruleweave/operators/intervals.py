"""Interval labels of a taxonomy by an Euler tour and distributed list ranking.

Concepts of a forest are numbered so that the descendants of a concept are the numbers after its own up to the end of
its interval: ``lo < x < hi``.  A descendant test is then a range predicate that needs no closure and that the
statistics of a Parquet table sorted by ``lo`` prune.

Only inner concepts (those with children, usually few) are on the tour; a leaf's number follows from its parent's and its place
among its siblings.  The tour is the list of the arcs down into and up out of every inner concept; each arc knows its
successor by one join.  List ranking by pointer jumping gives each arc the sum of the weights from it to the
end: in every round an arc adds its successor's sum and jumps to its successor's successor, so ``log2(arcs)`` rounds suffice
and their number is known beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.operators.graph import dictionary_encode
from ruleweave.operators.sizing import cut_lineage, fits, materialize, materialize_sized
from ruleweave.operators.skew import lookup_join_many


def _placed(pairs: DataFrame) -> DataFrame:
    """``<k, parent, child, at>``: edges numbered 0, 1, ... by parent and child, those without a parent (roots) first."""
    under = F.when(F.col("parent").isNotNull(), F.col("k")).alias("under")
    ids = dictionary_encode(pairs.select(F.struct(under, "parent", "k", "child").alias("label")))
    return ids.select("label.k", "label.parent", "label.child", F.col("id").alias("at"))


def list_ranks(arcs: DataFrame, n_arcs: int) -> DataFrame:
    """``<arc, next, weight, level>`` with both sums taken from the arc to the end of its list.

    ``next`` is null at an end.  An arc whose ``next`` is still set after ``log2`` rounds is on a cycle or leads into one.
    """
    ranked = cut_lineage(arcs)
    for _ in range(max(n_arcs, 1).bit_length()):
        after = ranked.select(F.col("arc").alias("_a"), F.col("next").alias("_next"), F.col("weight").alias("_w"), F.col("level").alias("_l"))
        ranked = cut_lineage(ranked.join(after, F.col("next") == F.col("_a"), "left").select(
            "arc", F.col("_next").alias("next"), (F.col("weight") + F.coalesce("_w", F.lit(0))).alias("weight"),
            (F.col("level") + F.coalesce("_l", F.lit(0))).alias("level")))
    return ranked


def interval_labels(edges: DataFrame) -> tuple[DataFrame, int]:
    """``<k, concept, lo, hi, depth>`` and the number of edges that the forest leaves out.

    ``edges`` is ``<k, child, parent>``.  A concept of several parents hangs under the first one by name; its other
    edges are left out and counted.  Siblings stand in the order of their names, leaves before inner concepts; roots (depth
    0) in the order of ontology and name.  Concepts on a cycle, and those under them, have no labels; their edges are
    counted as left out.  Repeated edges count once.
    """
    edges, n_edges = materialize(edges.select("k", "child", "parent").distinct())
    tree, n_tree = materialize(edges.groupBy("k", "child").agg(F.min("parent").alias("parent")))
    inner = cut_lineage(tree.select("k", F.col("parent").alias("concept")).distinct())
    child_of = tree.select("k", F.col("child").alias("concept"), "parent")
    # inner concepts hang under their parent, roots under nothing
    hung = inner.join(child_of, ["k", "concept"], "left").select("k", "parent", F.col("concept").alias("child"))
    placed, n_inner = materialize(_placed(hung))
    leaves = tree.join(inner.withColumnRenamed("concept", "child"), ["k", "child"], "left_anti")
    numbered = cut_lineage(_placed(leaves))
    firsts, n, size = materialize_sized(numbered.groupBy("k", "parent").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_leaves")))

    # arcs: 2 * at goes down into a concept, 2 * at + 1 up out of it
    first_child = placed.filter("parent is not null").groupBy("k", "parent").agg(F.min("at").alias("_child"))
    sibling = placed.select((F.col("at") - 1).alias("at"), F.col("at").alias("_next"), F.col("parent").alias("_sp"), F.col("k").alias("_sk"))
    up_to = placed.select("k", F.col("child").alias("parent"), F.col("at").alias("_up"))
    known = (placed.join(sibling, "at", "left")
             .join(first_child.withColumnRenamed("parent", "child"), ["k", "child"], "left")
             .join(firsts.select("k", F.col("parent").alias("child"), "_leaves"), ["k", "child"], "left")
             .join(up_to, ["k", "parent"], "left"))
    # roots of all ontologies follow one another
    same = (F.col("parent").isNull() & F.col("_sp").isNull()) | ((F.col("k") == F.col("_sk")) & (F.col("parent") == F.col("_sp")))
    follows = F.when(F.col("_next").isNotNull() & same, F.col("_next") * 2).otherwise(F.col("_up") * 2 + 1)
    down = F.struct((F.col("at") * 2).alias("arc"), F.coalesce(F.col("_child") * 2, F.col("at") * 2 + 1).alias("next"),
                    (F.coalesce("_leaves", F.lit(0)) + 1).cast("long").alias("weight"), F.lit(1).alias("level"))
    up = F.struct((F.col("at") * 2 + 1).alias("arc"), follows.alias("next"), F.lit(0).cast("long").alias("weight"), F.lit(-1).alias("level"))
    ranked = list_ranks(known.select(F.inline(F.array(down, up))), 2 * n_inner)

    # sums run to the end of the tour, so numbers count back from the largest one
    total = ranked.filter("next is null").agg(F.max("weight")).first()[0] or 0
    ends = ranked.filter("next is null").groupBy(F.floor(F.col("arc") / 2).alias("at")).agg(
        F.max(F.when(F.col("arc") % 2 == 0, F.col("weight"))).alias("_in"), F.max(F.when(F.col("arc") % 2 == 1, F.col("weight"))).alias("_out"),
        F.max(F.when(F.col("arc") % 2 == 0, F.col("level"))).alias("_level"))
    lead = placed.join(ends, "at").select("k", F.col("child").alias("concept"), (F.lit(total) - F.col("_in")).alias("lo"),
                                          (F.lit(total) - F.col("_out")).alias("hi"), (F.lit(0) - F.col("_level")).cast("int").alias("depth"))
    lead, n_lead, lead_size = materialize_sized(lead)
    of_parent = lead.join(firsts.withColumnRenamed("parent", "concept"), ["k", "concept"]).select(
        "k", F.col("concept").alias("parent"), "lo", "depth", "_first")
    under = lookup_join_many(numbered, of_parent, ["k", "parent"], lookup_small=fits(n_lead, lead_size) and fits(n, size))
    at = F.col("lo") + 1 + F.col("at") - F.col("_first")
    leaf = under.select("k", F.col("child").alias("concept"), at.alias("lo"), (at + 1).alias("hi"), (F.col("depth") + 1).alias("depth"))
    labels = cut_lineage(lead.unionByName(leaf).repartitionByRange("lo").sortWithinPartitions("lo"))
    n_labels = labels.count()
    n_roots = lead.filter("depth = 0").count()
    return labels, n_edges - (n_labels - n_roots)


def descendants_in(labels: DataFrame, k: int, concept: str) -> DataFrame:
    """``<leaf>``: all strict descendants of one concept, by its interval (one label row is looked up first)."""
    own = labels.filter((F.col("k") == k) & (F.col("concept") == concept)).select("lo", "hi").first()
    if own is None:
        return labels.limit(0).select(F.col("concept").alias("leaf"))
    return labels.filter((F.col("lo") > own["lo"]) & (F.col("lo") < own["hi"])).select(F.col("concept").alias("leaf"))
