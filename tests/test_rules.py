import pytest
from pyspark.sql import functions as F

from fixtures import EDGES, FACT_DDL, MAPPING, TOP, brute_force_rules, make_facts, simulate_counters
from ruleweave.operators import hierarchy as H
from ruleweave.operators import rules as R


@pytest.fixture(scope="module")
def data(spark):
    facts_rows = make_facts()
    facts = spark.createDataFrame(facts_rows, FACT_DDL)
    edges = spark.createDataFrame(EDGES, "k int, child string, parent string")
    anc = H.ancestor_sets(edges, TOP)
    return facts_rows, facts, edges, anc


def _as_dict(df, spec):
    cols = spec.rule_columns()
    return {tuple(r[c] for c in cols): (r["cov"], r["pos"]) for r in df.collect()}


@pytest.mark.parametrize("top_all", [True, False])
@pytest.mark.parametrize("expand_last", [False, True])
@pytest.mark.parametrize("min_pos", [2, 4])
def test_mine_matches_brute_force(spark, data, top_all, expand_last, min_pos):
    rows, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=min_pos, expand_last=expand_last,
                        top_matches_all=top_all)
    got = _as_dict(R.mine_rules(facts, edges, spec, anc), spec)
    want, *_ = brute_force_rules(rows, EDGES, MAPPING, min_pos=min_pos, top_matches_all=top_all,
                                 expand_last=expand_last)
    assert got == want
    assert len(got) > 5


def test_scores_and_summary(spark, data):
    rows, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=2)
    rules = R.mine_rules(facts, edges, spec, anc)
    n = len(rows)
    c = sum(1 for r in rows if r[-1])
    out = rules.collect()
    for r in out:
        assert r["pos"] <= r["cov"]
        assert r["score"] == n * r["pos"] - r["cov"] * c
        assert r["wracc"] == pytest.approx((r["cov"] / n) * (r["pos"] / r["cov"] - c / n))
        assert r["sup"] == pytest.approx(r["pos"] / c)
    s = R.rule_summary(rules).first()
    assert s["n_rules"] == len(out)
    assert s["avg_cov"] == pytest.approx(sum(r["cov"] for r in out) / n / len(out))
    assert s["avg_wracc"] == pytest.approx(sum(r["wracc"] for r in out) / len(out))


def test_generalisations_of_kept_rules_are_kept(spark, data):
    _, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=2, expand_last=True)
    got = _as_dict(R.mine_rules(facts, edges, spec, anc), spec)
    parent = {(k, c): p for k, c, p in EDGES}
    for key in got:
        for j, c in enumerate(key):
            if c is not None and (j, c) in parent:
                gen = list(key)
                gen[j] = parent[(j, c)]
                assert tuple(gen) in got


def test_raising_min_pos_shrinks(spark, data):
    _, facts, edges, anc = data
    a = _as_dict(R.mine_rules(facts, edges, R.MiningSpec(mapping=MAPPING, min_pos=2), anc),
                 R.MiningSpec(mapping=MAPPING))
    b = _as_dict(R.mine_rules(facts, edges, R.MiningSpec(mapping=MAPPING, min_pos=5), anc),
                 R.MiningSpec(mapping=MAPPING))
    assert set(b) < set(a)


def test_topk_and_cover_counters_match_sequential_loop(spark, data):
    rows, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=2)
    rules = R.mine_rules(facts, edges, spec, anc)
    top = R.select_rules(rules, spec, 10)
    top_rows = top.orderBy("rank").collect()
    assert [r["rank"] for r in top_rows] == list(range(1, len(top_rows) + 1))
    scores = [r["score"] for r in top_rows]
    assert scores == sorted(scores, reverse=True)
    _, rule_rows, pos_ids, all_ids = brute_force_rules(rows, EDGES, MAPPING, min_pos=2)
    selected = [{k: r[f"c{k}"] for k in range(3) if r[f"c{k}"] is not None} for r in top_rows]
    want = simulate_counters(rule_rows, selected, pos_ids, 50, 1)
    got = R.cover_counters(facts, edges, spec, top, population="positives", start=50, floor=1,
                           selected_bounded=True, ancestors=anc)
    assert {r["id"]: r["counter"] for r in got.collect()} == want
    # the same without a proof of the selection's size, and the facts are read once and not shuffled
    got = R.cover_counters(facts, edges, spec, top, population="positives", start=50, floor=1, ancestors=anc)
    assert {r["id"]: r["counter"] for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_cover_counters_all_rows_second_variant(spark, data):
    rows, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=4, top_matches_all=False)
    top = R.select_rules(R.mine_rules(facts, edges, spec, anc), spec, 3)
    sel = [{k: r[f"c{k}"] for k in range(3) if r[f"c{k}"] is not None} for r in top.orderBy("rank").collect()]
    _, rule_rows, _, all_ids = brute_force_rules(rows, EDGES, MAPPING, min_pos=4, top_matches_all=False)
    want = simulate_counters(rule_rows, sel, all_ids, 5, 4)
    got = R.cover_counters(facts, edges, spec, top, population="all", start=5, floor=4, ancestors=anc)
    assert {r["id"]: r["counter"] for r in got.collect()} == want
    assert 0 < len(want) < len(all_ids)


def test_rule_rows_and_concept_rows(spark, data):
    rows, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP)
    _, rule_rows, _, _ = brute_force_rules(rows, EDGES, MAPPING, min_pos=0)
    for terms in [{0: "Work"}, {1: "South"}, {0: "Office", 1: "Rome"}, {0: TOP, 1: "North", 2: "Saving"}]:
        got = {r["id"] for r in R.rule_rows(facts, edges, spec, terms, anc).collect()}
        assert got == rule_rows(terms)


def test_top_concepts(spark):
    facts = spark.createDataFrame(
        [(1, "Clerk", "Oslo", "Bond", None, True), (2, "Manager", "Bergen", "Deposit", "Bond", False)], FACT_DDL)
    edges = spark.createDataFrame(EDGES, "k int, child string, parent string")
    spec = R.MiningSpec(mapping=MAPPING, top=TOP)
    got = {(r["k"], r["concept"]) for r in R.top_concepts(facts, edges, spec).collect()}
    assert got == {(0, TOP), (0, "Work"), (0, "Office"), (1, TOP), (1, "North"), (2, TOP), (2, "Saving")}


def test_empty_rule_set(spark, data):
    _, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=10_000)
    rules = R.mine_rules(facts, edges, spec, anc)
    assert rules.count() == 0
    s = R.rule_summary(rules).first()
    assert s["n_rules"] == 0 and s["avg_cov"] is None


def test_duplicate_fact_rows_counted_per_row(spark):
    """Facts are counted per row; with a unique key this equals distinct rows."""
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=0)
    edges = spark.createDataFrame(EDGES, "k int, child string, parent string")
    facts = spark.createDataFrame([(1, "Clerk", "Oslo", None, None, True), (2, "Clerk", "Oslo", None, None, True)],
                                  FACT_DDL)
    r = R.mine_rules(facts, edges, spec).filter(F.col("c0") == "Clerk").filter(F.col("c1").isNull()).first()
    assert (r["cov"], r["pos"]) == (2, 2)


def test_permuting_rows_and_partitions_changes_nothing(spark, data):
    rows, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=2, expand_last=True)
    base = _as_dict(R.mine_rules(facts, edges, spec, anc), spec)
    shuffled = spark.createDataFrame(list(reversed(rows)), FACT_DDL).repartition(7, "city")
    assert _as_dict(R.mine_rules(shuffled, edges.repartition(3), spec), spec) == base


def test_concepts_match_by_equality_not_substring(spark):
    edges = spark.createDataFrame([(0, "Car", TOP), (0, "Career", TOP), (1, "Any", TOP)],
                                  "k int, child string, parent string")
    facts = spark.createDataFrame([(1, "Career", "Any", True), (2, "Career", "Any", True), (3, "Car", "Any", False)],
                                  "id long, job string, city string, target boolean")
    spec = R.MiningSpec(mapping={0: ["job"], 1: ["city"]}, top=TOP, min_pos=0)
    got = {r["c0"]: (r["cov"], r["pos"]) for r in R.mine_rules(facts, edges, spec).filter("c1 is null").collect()}
    assert got == {TOP: (3, 2), "Career": (2, 2)}


def test_cover_counters_of_more_rules_than_a_word_has_bits(spark, data):
    rows, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=0, expand_last=True)
    rules = R.mine_rules(facts, edges, spec, anc)
    chosen = rules.collect()
    assert len(chosen) > 128
    _, rule_rows, pos_ids, _ = brute_force_rules(rows, EDGES, MAPPING, min_pos=0)
    selected = [{k: r[f"c{k}"] for k in range(3) if r[f"c{k}"] is not None} for r in chosen]
    want = simulate_counters(rule_rows, selected, pos_ids, 1000, 1)
    got = R.cover_counters(facts, edges, spec, rules, population="positives", start=1000, floor=1, ancestors=anc)
    assert {r["id"]: r["counter"] for r in got.collect()} == want


@pytest.mark.parametrize("k", [1, 40])
@pytest.mark.parametrize("options", [dict(min_pos=2), dict(min_pos=4, top_matches_all=False), dict(min_pos=1, expand_last=True),
                                     dict(min_pos=0, max_terms=1), dict(min_pos=3, max_terms=2)])
def test_bounded_search_equals_full_search(spark, data, k, options):
    _, facts, edges, anc = data
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, **options)
    full = R.mine_rules(facts, edges, spec, anc)
    want = [tuple(r) for r in R.select_rules(full, spec, k).orderBy("rank").collect()]
    trace = []
    got = R.mine_top_rules(facts, edges, spec, k, anc, trace)
    assert got.columns == R.select_rules(full, spec, k).columns
    assert [tuple(r) for r in got.orderBy("rank").collect()] == want
    if k == 1 and spec.n_terms == 3:
        # candidates of the deeper levels against all rules of that many terms
        assert sum(trace[1:]) < full.filter("c1 is not null").count()
