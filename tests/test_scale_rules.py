"""Results do not depend on partition counts, bounds raise instead of stopping, skewed keys are split, one pass where promised."""

import pytest
from pyspark.sql import functions as F

from ruleweave.operators import graph as G
from ruleweave.operators import hierarchy as H
from ruleweave.operators import rules as R
from ruleweave.operators import sets as S
from ruleweave.operators.sizing import is_small
from ruleweave.operators.skew import lookup_join
from ruleweave.sources.ntriples import classify_lines, parse_ntriples


@pytest.mark.parametrize("parts", [None, 3, 16])
def test_dense_ids_follow_labels(spark, parts):
    n = 200_000
    terms = spark.range(n).select(F.format_string("t%07d", (F.col("id") * 7919) % n).alias("label"))
    wrong = G.dictionary_encode(terms, num_partitions=parts).filter(
        F.col("id") != F.substr("label", F.lit(2)).cast("long")).count()
    assert wrong == 0


def path(spark, n):
    return spark.createDataFrame([(0, f"c{i + 1}", f"c{i}") for i in range(n)], "k int, child string, parent string")


def test_bounds_raise(spark):
    edges = path(spark, 12)
    assert H.closure(edges).count() == 12 * 13 // 2
    with pytest.raises(RuntimeError):
        H.closure(edges, max_rounds=1)
    line = spark.createDataFrame([(i, i + 1) for i in range(40)], "src long, dst long")
    ids = spark.range(41)
    assert G.connected_components(ids, line).select("component").distinct().count() == 1
    with pytest.raises(RuntimeError):
        G.connected_components(ids, line, max_rounds=0)
    with pytest.raises(RuntimeError):
        G.pagerank(ids, line, max_iter=2, tol=1e-12)


def test_null_and_equal_rows_are_spread(spark):
    probe = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).alias("key"), F.lit(1).alias("x"))
    lookup = spark.createDataFrame([("hot", 1), ("cold", 2)], "key2 string, val int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(probe, lookup, "key", "key2", how="left", broadcast_rows=0, chunk_rows=1000)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 40_000 and max(sizes) < 12_000


def test_byte_bound(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("s"))
    assert is_small(wide) and not is_small(wide, max_bytes=100_000) and not is_small(wide, max_rows=99)


def test_one_pass(spark, tmp_path):
    spark.createDataFrame([(1, "a", "b"), (2, "a", None)], "id long, x string, y string").write.parquet(str(tmp_path / "t"))
    plan = S.distinct_values(spark.read.parquet(str(tmp_path / "t")), ["x", "y"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(tuple(r) for r in plan.collect()) == [("x", "a"), ("y", "b")]


def test_only_named_ontologies_are_joined(spark):
    spec = R.MiningSpec(mapping={0: ["a"], 1: ["b"]}, top="Thing")
    anc = spark.createDataFrame([(0, "x", ["Thing", "x"]), (1, "y", ["Thing", "y"])], "k int, value string, ancs array<string>")
    facts = spark.createDataFrame([(1, "x", "y", True), (2, "z", "y", False)], "id long, a string, b string, target boolean")
    rows = R.rule_rows(facts, None, spec, {0: "x"}, anc)
    assert [r.id for r in rows.collect()] == [1]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_escapes_labels_and_tabs(spark):
    lines = [r'<http://e/caf\u00e9> <http://e/p> "x\U0001F600y" .', "_:é1 <http://e/p> _:a:b .", r'_:a.b <http://e/p> "a\\U0001F600\t\"" .',
             "\t# comment", "\t", r'<http://e/s> <http://e/p> "bad \x" .', r'<http://e/s> <http://e/p> "it\'s" .',
             '<http://e/s> <http://e/p> "' + "long " * 20_000 + '" .', r'<http://e/s> <http://e/p> "' + r"\n" * 20_000 + '" .']
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    kinds = [r.line_kind for r in classify_lines(frame).collect()]
    assert kinds == ["triple", "triple", "triple", "comment", "blank", "malformed", "triple", "triple", "triple"]
    got = [(r.s, r.o) for r in parse_ntriples(frame).collect()]
    assert got[:4] == [("http://e/café", "x😀y"), ("_:é1", "_:a:b"), ("_:a.b", 'a\\U0001F600\t"'), ("http://e/s", "it's")]
    assert len(got) == 6 and len(got[4][1]) == 100_000 and got[5][1] == "\n" * 20_000
    plan = parse_ntriples(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1
