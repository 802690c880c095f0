import os
import tempfile

from ruleweave.operators import sets as S
from ruleweave.sources.ntriples import read_taxonomy_files
from ruleweave.sources.tables import inline, read_delimited, read_with_rejects


def test_set_algebra(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (3, "z")], "id int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z"), (4, "w")], "id int, v string")
    c = spark.createDataFrame([(3, "z"), (2, "y")], "id int, v string")
    assert sorted(tuple(r) for r in S.intersect_all([a, b, c]).collect()) == [(2, "y"), (3, "z")]
    assert S.union_all([a, b]).count() == 7
    assert S.union_distinct([a, b]).count() == 4
    assert sorted(tuple(r) for r in S.except_distinct(a, b).collect()) == [(1, "x")]
    assert S.join_on_all_columns(a.distinct(), b).count() == 2
    assert [r.id for r in S.uncovered(a, b, "id").collect()] == [1]
    assert S.is_subset(c, a, "id") and not S.is_subset(b, a, "id")
    dv = {(r.column, r.value) for r in S.distinct_values(a, ["id", "v"]).collect()}
    assert ("id", "1") in dv and ("v", "z") in dv and len(dv) == 6


def test_set_operators_need_one_shuffle_and_know_nulls(spark):
    rows = [(1, None), (None, None), (2, "y"), (2, "y"), (3, "z")]
    a = spark.createDataFrame(rows, "id int, v string")
    b = spark.createDataFrame([(None, None), (2, "y"), (1, "x")], "id int, v string")
    c = spark.createDataFrame([(2, "y"), (None, None), (None, None)], "key int, w string")
    for got, want in [(S.intersect_all([a, b, c]), a.intersect(b).intersect(c)), (S.except_distinct(a, b), a.subtract(b)),
                      (S.intersect_all([a] * 130), a.distinct()), (S.intersect_all([a]), a.distinct())]:
        assert got.columns == a.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    for df in (S.intersect_all([a, b, c]), S.except_distinct(a, b), S.union_distinct([a, b])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan


def test_rejected_lines_are_kept(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"part{i}.tsv").write_text(f"id\tjob\ttarget\n{i}1\tClerk\tYes\n{i}2\tbroken\n{i}3\ta\tb\tc\n{i}4\t\tNo\n")
    rows, rejects = read_with_rejects(spark, str(tmp_path), ["id", "job", "target"])
    assert sorted(tuple(r) for r in rows.collect()) == [("01", "Clerk", "Yes"), ("04", None, "No"), ("11", "Clerk", "Yes"), ("14", None, "No")]
    assert sorted(r.line for r in rejects.collect()) == sorted(x for i in range(2) for x in (f"{i}2\tbroken", f"{i}3\ta\tb\tc"))
    assert rows.count() + rejects.count() == 8


def test_one_scan_of_many_taxonomy_files(spark, tmp_path):
    line = "<http://x/{0}#c> <http://www.w3.org/2000/01/rdf-schema#subClassOf> <http://x/{0}#p> .\n"
    (tmp_path / "a b.nt").write_text("# comment\n" + line.format("one"))
    (tmp_path / "folder").mkdir()
    for i in range(3):
        (tmp_path / "folder" / f"f{i}.nt").write_text(line.format(f"two{i}"))
    paths = [str(tmp_path / "folder"), "file://" + str(tmp_path / "a b.nt"), str(tmp_path / "folder") + "/"]
    df = read_taxonomy_files(spark, paths)
    assert sorted((r.k, r.s) for r in df.collect()) == [(0, f"http://x/two{i}#c") for i in range(3)] + [(1, "http://x/one#c")]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_null_never_joins_on_all_columns(spark):
    a = spark.createDataFrame([(1, None), (2, "y")], "id int, v string")
    assert S.join_on_all_columns(a, a).count() == 1


def test_read_delimited_and_inline(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    path = os.path.join(d, "facts.tsv")
    with open(path, "w") as f:
        f.write("id\tjob\ttarget\n1\tClerk\tYes\n2\tFarmer\tNo\n3\tbroken\n")
    df = read_delimited(spark, path, ["id", "job", "target"])
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", "Clerk", "Yes"), ("2", "Farmer", "No")]
    df2 = read_delimited(spark, path)
    assert df2.columns == ["id", "job", "target"] and dict(df2.dtypes)["id"] == "string"
    t = inline(spark, [(0, "a b")], "label int, text string")
    assert t.dtypes == [("label", "int"), ("text", "string")]
