"""A mining run over files, against the set-counting model."""

import pytest

from fixtures import EDGES, MAPPING, TOP, brute_force_rules, make_facts, simulate_counters
from ruleweave.operators import rules as R
from ruleweave.plans.mining import run_mining

SUB = "http://www.w3.org/2000/01/rdf-schema#subClassOf"


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("mining")
    rows = make_facts()
    lines = ["\t".join(["id", "job", "city", "p1", "p2", "target"])]
    for r in [*rows, *rows[:25]]:  # some rows twice
        lines.append("\t".join("" if x is None else str(x).lower() if isinstance(x, bool) else str(x) for x in r))
    (folder / "facts.tsv").write_text("\n".join(lines) + "\n")
    for k in MAPPING:
        nt = [f"<http://x/{k}#{c}> <{SUB}> <http://x/{k}#{p}> ." for j, c, p in EDGES if j == k]
        (folder / f"t{k}.nt").write_text("# taxonomy\n" + "\n".join(nt) + "\n")
    return rows, str(folder / "facts.tsv"), [str(folder / f"t{k}.nt") for k in MAPPING]


def found(run, spec):
    return {tuple(r[c] for c in spec.rule_columns()): (r["cov"], r["pos"]) for r in run.rules.collect()}


def test_run_over_files(spark, files):
    rows, facts, taxonomies = files
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=2)
    once = run_mining(spark, facts, taxonomies, spec, distinct=True)
    want, covered, positive, _ = brute_force_rules(rows, EDGES, MAPPING, min_pos=2)
    assert found(once, spec) == want
    top = once.selected(5)
    chosen = [{k: r[f"c{k}"] for k in range(3) if r[f"c{k}"] is not None} for r in top.orderBy("rank").collect()]
    got = {int(r["id"]): r["counter"] for r in once.counters(top).collect()}
    assert got == simulate_counters(covered, chosen, positive, 50, 1)
    assert once.summary().first()["n_rules"] == len(want)


def test_repeated_rows_count_unless_distinct(spark, files):
    rows, facts, taxonomies = files
    spec = R.MiningSpec(mapping=MAPPING, top=TOP, min_pos=2)
    every = run_mining(spark, facts, taxonomies, spec)
    renumbered = [*rows, *((1000 + r[0], *r[1:]) for r in rows[:25])]
    assert found(every, spec) == brute_force_rules(renumbered, EDGES, MAPPING, min_pos=2)[0]


def test_profile_merges_what_rules_cannot_tell_apart(spark):
    edges = spark.createDataFrame([(0, f"leaf{i}", "Group") for i in range(50)] + [(0, "Group", TOP), (1, "x", TOP)],
                                  "k int, child string, parent string")
    facts = spark.createDataFrame([(i, f"leaf{i % 50}", "x", True) for i in range(100)],
                                  "id long, a string, b string, target boolean")
    spec = R.MiningSpec(mapping={0: ["a"], 1: ["b"]}, top=TOP, min_pos=4)
    counted = R.profile_of(facts, spec)
    anc = R.ancestor_sets(edges, TOP)
    cut = R.restrict_ancestors(anc, R.frequent_concepts(counted, anc, spec))
    assert R.concept_profile(counted, cut, spec).count() == 1
    rules = {(r.c0, r.c1): r.pos for r in R.mine_rules(facts, edges, spec, anc).collect()}
    assert rules == {(TOP, None): 100, ("Group", None): 100, (TOP, TOP): 100, ("Group", TOP): 100}
