import random

import numpy as np
import pytest

from ruleweave.operators import graph as G


def _graph(spark, n=60, m=90, seed=3):
    rnd = random.Random(seed)
    triples = [(f"v{rnd.randrange(n):03d}", "p" if rnd.random() < 0.7 else "q", f"v{rnd.randrange(n):03d}")
               for _ in range(m)]
    df = spark.createDataFrame(triples, "s string, p string, o string")
    return triples, df


def test_dictionary_ids_follow_label_order(spark):
    labels = [f"t{i:04d}" for i in random.Random(1).sample(range(5000), 700)]
    df = spark.createDataFrame([(x,) for x in labels + labels[:50]], "label string")
    got = {r.label: r.id for r in G.dictionary_encode(df, num_partitions=7).collect()}
    assert got == {lab: i for i, lab in enumerate(sorted(set(labels)))}


def test_edges_and_degrees(spark):
    triples, df = _graph(spark)
    v, e = G.build_graph(df)
    lab = {r.id: r.label for r in v.collect()}
    got = sorted((lab[r.src], r.attr, lab[r.dst]) for r in e.collect())
    assert got == sorted(triples)
    deg = {lab[r.id]: r.out_degree for r in G.out_degrees(e).collect()}
    assert sum(deg.values()) == len(triples)
    assert G.subgraph(e, "q").count() == sum(1 for t in triples if t[1] == "q")


def test_components_match_union_find(spark):
    triples, df = _graph(spark, n=80, m=60)
    v, e = G.build_graph(df)
    sub = G.subgraph(e, "p")
    ids = [r.id for r in v.collect()]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for r in sub.collect():
        a, b = find(r.src), find(r.dst)
        if a != b:
            parent[max(a, b)] = min(a, b)
    groups = {}
    for i in ids:
        groups.setdefault(find(i), []).append(i)
    want = {i: min(g) for g in groups.values() for i in g}
    got = {r.id: r.component for r in G.connected_components(v, sub).collect()}
    assert got == want
    assert all(c <= i for i, c in got.items())


def test_components_long_chain(spark):
    n = 40
    order = list(range(n))
    random.Random(5).shuffle(order)
    triples = [(f"n{order[i]:02d}", "p", f"n{order[i + 1]:02d}") for i in range(n - 1)]
    v, e = G.build_graph(spark.createDataFrame(triples, "s string, p string, o string"))
    comps = {r.component for r in G.connected_components(v, e).collect()}
    assert comps == {0}


def test_components_hooks_only_larger_ends(spark, monkeypatch):
    # two hubs with many leaves of smaller ids: in the first round, whose pairs are the most, only the hubs hook
    smalls = []
    joined = G.lookup_join
    monkeypatch.setattr(G, "lookup_join", lambda *a, **kw: smalls.append(kw["lookup_small"]) or joined(*a, **kw))
    v = spark.range(42)
    e = spark.createDataFrame([(40 + i % 2, i, "p") for i in range(40)] + [(41, 40, "p")] * 2, "src bigint, dst bigint, attr string")
    assert {r.component for r in G.connected_components(v, e, broadcast_rows=10).collect()} == {0}
    assert smalls[:4] == [True] * 4  # two jumps, two ends


@pytest.mark.parametrize("broadcast_rows", [3, 500_000])
def test_components_maps_of_several_rounds(spark, broadcast_rows):
    # vertices that hook in a later round only, long chains and a hub, by shuffles and by broadcasts
    rnd = random.Random(broadcast_rows)
    graphs = ([(9, 8), (8, 7), (7, 6), (6, 5), (5, 4), (4, 3), (3, 2), (2, 1), (1, 0)],
              [(1, 8), (0, 9), (8, 9), (2, 7), (3, 7), (7, 30), (30, 0)], [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)],
              [(50, i) for i in range(1, 20)] + [(51, 50), (51, 0)])
    edges = [(60 * k + a, 60 * k + b) for k, g in enumerate(graphs) for a, b in g]
    up = list(range(240))
    for _ in range(60):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    e = spark.createDataFrame([(a, b, "p") for a, b in edges], "src bigint, dst bigint, attr string")
    got = G.connected_components(spark.range(240), e, broadcast_rows=broadcast_rows, chunk_rows=5).collect()
    assert sorted((r.id, r.component) for r in got) == list(enumerate(up))


def _pagerank_np(n, edges, iters, reset=0.15):
    out = np.zeros(n)
    for s, d in edges:
        out[s] += 1
    r = np.ones(n)
    for _ in range(iters):
        c = np.zeros(n)
        for s, d in edges:
            c[d] += r[s] / out[s]
        r = reset + (1 - reset) * c
    return r


def test_pagerank_fixed_iterations(spark):
    triples, df = _graph(spark)
    v, e = G.build_graph(df)
    n = v.count()
    edges = [(r.src, r.dst) for r in e.collect()]
    want = _pagerank_np(n, edges, 15)
    got = {r.id: r.rank for r in G.pagerank(v, e, max_iter=15).collect()}
    assert np.allclose([got[i] for i in range(n)], want, atol=1e-12)


@pytest.mark.parametrize("broadcast_rows", [2, 500_000])
def test_pagerank_rounds_by_every_join(spark, broadcast_rows):
    rnd = random.Random(7)
    pairs = [(rnd.randrange(40), rnd.randrange(50)) for _ in range(120)] + [(3, i) for i in range(50)]
    v, e = spark.range(55), spark.createDataFrame([(a, b, "p") for a, b in pairs], "src bigint, dst bigint, attr string")
    for rounds in (0, 1, 4):
        got = {r.id: r.rank for r in G.pagerank(v, e, max_iter=rounds, broadcast_rows=broadcast_rows, chunk_rows=4).collect()}
        assert np.allclose([got[i] for i in range(55)], _pagerank_np(55, pairs, rounds), atol=1e-12)
    assert G.pagerank(v, e.limit(0), max_iter=3).filter("rank != 0.15").count() == 0


def test_pagerank_ends_with_the_longest_walk(spark):
    # sources and sinks: no walk has two edges, so the second of twenty rounds has nothing to send
    e = spark.createDataFrame([(i, 10 + i % 3, "p") for i in range(10)], "src bigint, dst bigint, attr string")
    walks = G.walk_rounds(e, max_iter=20)
    assert {(r.round, r.id, r.sends) for r in walks.collect()} == {(1, 10, False), (1, 11, False), (1, 12, False)}
    got = {r.id: r.rank for r in G.pagerank(spark.range(13), e, max_iter=20).collect()}
    assert np.allclose([got[i] for i in range(13)], _pagerank_np(13, [(i, 10 + i % 3) for i in range(10)], 20), atol=1e-12)


def test_pagerank_tolerance_and_normalize(spark):
    triples, df = _graph(spark)
    v, e = G.build_graph(df)
    n = v.count()
    edges = [(r.src, r.dst) for r in e.collect()]
    fixed = _pagerank_np(n, edges, 200)
    got = {r.id: r.rank for r in G.pagerank(v, e, max_iter=500, tol=1e-9).collect()}
    assert np.allclose([got[i] for i in range(n)], fixed, atol=1e-7)
    norm = G.pagerank(v, e, max_iter=30, normalize=True)
    assert sum(r.rank for r in norm.collect()) == pytest.approx(n)
    top = G.ranked_vertices(G.pagerank(v, e, max_iter=15), v, k=3).collect()
    assert [r.rank for r in top] == sorted([r.rank for r in top], reverse=True)


def test_pagerank_senders_shrink(spark):
    # a long chain, a cycle and a hub with many leaves: the chain is done soon, the cycle goes on
    triples = [(f"c{i:03d}", "p", f"c{i + 1:03d}") for i in range(30)]
    triples += [("k0", "p", "k1"), ("k1", "p", "k2"), ("k2", "p", "k0")] + [(f"l{i}", "p", "hub") for i in range(50)]
    v, e = G.build_graph(spark.createDataFrame(triples, "s string, p string, o string"))
    n, tol = v.count(), 1e-4
    edges = [(r.src, r.dst) for r in e.collect()]
    degree = {}
    for s, _ in edges:
        degree[s] = degree.get(s, 0) + 1
    rounds = G.residual_rounds(v, e, tol, max_iter=200)
    log = [(r.round, r.id, r.residual) for r in rounds.collect()]
    last = max(r for r, _, _ in log)
    active = [sum(degree.get(i, 0) for r, i, x in log if r == k and x > tol) for k in range(last + 1)]
    assert active[0] == len(edges) and active[-1] == 0
    assert all(a >= b for a, b in zip(active, active[1:])) and active[40] == 3  # only the cycle is left
    want = _pagerank_np(n, edges, 400)
    for rows in (500_000, 20):  # always broadcast, and once the senders are few
        got = {r.id: r.rank for r in G.pagerank(v, e, max_iter=200, tol=tol, broadcast_rows=rows, chunk_rows=10).collect()}
        assert sorted(got) == list(range(n))
        assert sum(abs(got[i] - want[i]) for i in range(n)) <= n * tol * 0.85 / 0.15
    assert G.pagerank(v.limit(0), e.limit(0), tol=tol).collect() == []
    with pytest.raises(RuntimeError):
        G.pagerank(v, e, max_iter=3, tol=tol)
