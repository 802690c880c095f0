"""Interval labels by list ranking against a walk over the tree, and descendants without a closure."""

import random

import pytest

from fixtures import EDGES
from ruleweave.operators import hierarchy as H
from ruleweave.operators import intervals as I

SCHEMA = "k int, child string, parent string"


def walk(edges):
    kids, have_parent = {}, set()
    for k, c, p in sorted(set(edges)):
        kids.setdefault((k, p), []).append(c)
        have_parent.add((k, c))
    out, at = {}, 0

    def visit(k, c, depth):
        nonlocal at
        lo, at = at, at + 1
        for inner in (False, True):
            for x in kids.get((k, c), ()):
                if ((k, x) in kids) == inner:
                    visit(k, x, depth + 1)
        out[(k, c)] = (lo, at, depth)

    for k, p in sorted(kids):
        if (k, p) not in have_parent:
            visit(k, p, 0)
    return out


def labels_of(spark, edges):
    labels, left_out = I.interval_labels(spark.createDataFrame(edges, SCHEMA))
    return labels, {(r.k, r.concept): (r.lo, r.hi, r.depth) for r in labels.collect()}, left_out


def below(edges, k, concept):
    found, todo = set(), [concept]
    while todo:
        x = todo.pop()
        for k2, c, p in edges:
            if k2 == k and p == x and c not in found:
                found.add(c)
                todo.append(c)
    return found


def test_labels_of_the_fixture_taxonomies(spark):
    labels, got, left_out = labels_of(spark, EDGES + EDGES[:3])
    assert got == walk(EDGES) and left_out == 0
    for k, c in got:
        assert {r.leaf for r in I.descendants_in(labels, k, c).collect()} == below(EDGES, k, c)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests(spark, seed):
    rng = random.Random(seed)
    edges = []
    for k in range(2):
        for i in range(1, 250):
            if rng.random() < 0.95:
                edges.append((k, f"c{i}", f"c{rng.randrange(max(0, i - 30), i)}"))
    edges += [(0, f"leaf{i}", "c0") for i in range(300)]  # one parent holds many leaves
    _, got, left_out = labels_of(spark, edges)
    assert got == walk(edges) and left_out == 0


def test_a_deep_chain(spark):
    edges = [(0, f"n{i + 1:04}", f"n{i:04}") for i in range(1000)]
    labels, got, left_out = labels_of(spark, edges)
    assert left_out == 0 and got[(0, "n0000")] == (0, 1001, 0) and got[(0, "n1000")] == (1000, 1001, 1000)
    assert I.descendants_in(labels, 0, "n0600").count() == 400


def test_several_parents_and_cycles(spark):
    dag = [(0, "b", "a"), (0, "c", "a"), (0, "d", "b"), (0, "d", "c"), (0, "e", "d"), (0, "f", "e")]
    cycle = [(1, "x", "y"), (1, "y", "z"), (1, "z", "x"), (1, "leaf", "x"), (1, "in", "leaf2"), (1, "x", "in")]
    _, got, left_out = labels_of(spark, dag + cycle)
    assert left_out >= 1 and got[(0, "d")][2] == 2
    e = spark.createDataFrame(dag + cycle, SCHEMA)
    for k, concept in [(0, "a"), (0, "c"), (0, "b"), (0, "f"), (1, "x"), (1, "leaf2"), (1, "nowhere")]:
        assert {r.leaf for r in H.descendants(e, k, concept).collect()} == below(dag + cycle, k, concept)


def test_nothing(spark):
    labels, left_out = I.interval_labels(spark.createDataFrame([], SCHEMA))
    assert labels.count() == 0 and left_out == 0 and I.descendants_in(labels, 0, "x").count() == 0


def test_the_range_is_pushed_to_the_scan(spark):
    labels, _, _ = labels_of(spark, EDGES)
    plan = I.descendants_in(labels, 0, "Work")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(lo," in plan and "LessThan(lo," in plan
