import random

import pytest
from pyspark.sql import functions as F

from ruleweave.operators import graph as G
from ruleweave.operators.skew import lookup_join, lookup_join_many


def _probe(spark):
    rnd = random.Random(11)
    # one key holds about a third of all rows
    rows = [(i, "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}", rnd.random()) for i in range(600)]
    rows += [(600 + i, None, 0.5) for i in range(5)]
    return spark.createDataFrame(rows, "id long, key string, x double")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_join_equals_plain_join(spark, how):
    probe = _probe(spark)
    lookup = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 40, 2)], "key2 string, val int")
    want = sorted(tuple(r) for r in probe.join(lookup, probe.key == lookup.key2, how).select("id", "key", "x", "val").collect())
    got_small = lookup_join(probe, lookup, "key", "key2", how=how)
    got_salted = lookup_join(probe, lookup, "key", "key2", how=how, broadcast_rows=0, chunk_rows=25)
    assert sorted(tuple(r) for r in got_small.collect()) == want
    assert sorted(tuple(r) for r in got_salted.collect()) == want
    # the hot key really is split over several salts
    plan = got_salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_lookup_join_many_is_null_safe(spark):
    probe = spark.createDataFrame([(1, None, "a"), (2, "x", None), (3, "x", "a")], "id int, u string, v string")
    lookup = spark.createDataFrame([(None, "a", 10), ("x", None, 20)], "u string, v string, n int")
    for kw in ({}, {"broadcast_rows": 0, "chunk_rows": 1}):
        got = {r.id: r.n for r in lookup_join_many(probe, lookup, ["u", "v"], how="left", **kw).collect()}
        assert got == {1: 10, 2: 20, 3: None}


def _star_graph(spark):
    # a hub with many edges plus a few small components
    triples = [("hub", "p", f"leaf{i:03d}") for i in range(120)]
    triples += [("a", "p", "b"), ("b", "p", "c"), ("x", "p", "y")]
    triples += [(f"leaf{i:03d}", "p", "hub") for i in range(0, 120, 7)]
    return G.build_graph(spark.createDataFrame(triples, "s string, p string, o string"))


def test_components_salted_branch(spark):
    v, e = _star_graph(spark)
    want = {r.id: r.component for r in G.connected_components(v, e).collect()}
    got = {r.id: r.component for r in G.connected_components(v, e, broadcast_rows=0, chunk_rows=10).collect()}
    assert got == want
    assert len(set(want.values())) == 3


def test_pagerank_salted_branch(spark):
    v, e = _star_graph(spark)
    want = {r.id: r.rank for r in G.pagerank(v, e, max_iter=8).collect()}
    got = {r.id: r.rank for r in G.pagerank(v, e, max_iter=8, broadcast_rows=0, chunk_rows=10).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12)
