from fixtures import EDGES, TOP
from ruleweave.operators import hierarchy as H
from ruleweave.sources.ntriples import parse_ntriples
from pyspark.sql import functions as F


def _closure_py(edges):
    par = {}
    for k, c, p in edges:
        par.setdefault((k, c), set()).add(p)
    out = {}
    for (k, c) in list(par):
        frontier, d = {c}, 0
        seen = set()
        while frontier:
            d += 1
            nxt = set()
            for x in frontier:
                for p in par.get((k, x), ()):
                    if (k, p, c) not in out:
                        out[(k, p, c)] = d
                        nxt.add(p)
            frontier = nxt - seen
            seen |= nxt
    return out


def test_closure_tree(spark):
    e = spark.createDataFrame(EDGES, "k int, child string, parent string")
    got = {(r.k, r.anc, r.leaf): r.depth for r in H.closure(e).collect()}
    assert got == _closure_py(EDGES)
    # transitive and idempotent
    pairs = {(k, a, l) for (k, a, l) in got}
    for (k, a, l) in pairs:
        for (k2, a2, l2) in pairs:
            if k == k2 and l == a2:
                assert (k, a, l2) in pairs


def test_closure_dag_and_cycle(spark):
    edges = [(0, "b", "a"), (0, "c", "a"), (0, "d", "b"), (0, "d", "c"), (0, "e", "d"),
             (1, "x", "y"), (1, "y", "z"), (1, "z", "x")]
    e = spark.createDataFrame(edges, "k int, child string, parent string")
    got = {(r.k, r.anc, r.leaf): r.depth for r in H.closure(e).collect()}
    assert got[(0, "a", "e")] == 3 and got[(0, "a", "d")] == 2
    cyc = {(a, l) for (k, a, l) in got if k == 1}
    assert cyc == {(a, l) for a in "xyz" for l in "xyz"}


def test_children_concepts_ancestors(spark):
    e = spark.createDataFrame(EDGES + [(0, "Orphan", "Nowhere")], "k int, child string, parent string")
    ch = {}
    for r in H.children(e).collect():
        ch.setdefault((r.k, r.parent), []).append((r.child, r.n_children))
    assert sorted(ch[(0, "Office")]) == [("Clerk", 2), ("Manager", 2)]
    assert H.concepts(e).filter("k = 1").count() == 8
    anc = {(r.k, r.value): r.ancs for r in H.ancestor_sets(e, TOP).collect()}
    assert anc[(1, "Trastevere")] == ["Rome", "South", "Thing", "Trastevere"]
    assert (0, "Orphan") not in anc  # not under the top concept
    assert [r.child for r in H.children_of(e, 0, "Idle").orderBy("child").collect()] == ["Retired", "Student"]


def test_edges_and_dictionary_from_ntriples(spark):
    sub = "http://www.w3.org/2000/01/rdf-schema#subClassOf"
    lines = [f"<http://ex.org/o#B> <{sub}> <http://ex.org/o#A> .",
             "<http://ex.org/o#B> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://www.w3.org/2002/07/owl#Class> .",
             f'<http://ex.org/o#C> <{sub}> "lit" .']
    t = parse_ntriples(spark.createDataFrame([(x,) for x in lines], "value string")).withColumn("k", F.lit(0))
    assert [(r.k, r.child, r.parent) for r in H.subclass_edges(t).collect()] == [(0, "B", "A")]
    d = {r.uri: r.local_name for r in H.uri_dictionary(t).collect()}
    assert d == {"http://ex.org/o#B": "B", "http://ex.org/o#A": "A", "http://ex.org/o#C": "C",
                 "http://www.w3.org/2002/07/owl#Class": "Class"}


def test_closure_idempotent(spark):
    e = spark.createDataFrame(EDGES, "k int, child string, parent string")
    once = H.closure(e)
    as_edges = once.select("k", F.col("leaf").alias("child"), F.col("anc").alias("parent"))
    twice = {(r.k, r.anc, r.leaf) for r in H.closure(as_edges).collect()}
    assert twice == {(r.k, r.anc, r.leaf) for r in once.collect()}
