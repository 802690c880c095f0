from ruleweave.operators import triples as T
from ruleweave.sources.ntriples import parse_ntriples, without_comments

LINES = [
    "# a comment line",
    "",
    "<http://ex.org/a> <http://ex.org/p> <http://ex.org/b> .",
    '<http://ex.org/a> <http://ex.org/name> "plain" .',
    '<http://ex.org/a> <http://ex.org/label> "tagged"@en-GB .',
    '<http://ex.org/a> <http://ex.org/n> "42"^^<http://www.w3.org/2001/XMLSchema#int> .',
    r'<http://ex.org/a> <http://ex.org/q> "say \"hi\" <b> and \\ back\nslash é" . # trailing',
    "_:b1 <http://ex.org/p> _:b2 .",
    "   <http://ex.org/c> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://ex.org/C> .",
    "<http://ex.org/a> <http://ex.org/p> broken",
    "not a triple at all",
]


def test_parse_shapes(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    got = {(r.s, r.p, r.o): r for r in parse_ntriples(lines).collect()}
    assert len(got) == 7
    r = got[("http://ex.org/a", "http://ex.org/p", "http://ex.org/b")]
    assert (r.s_kind, r.o_kind, r.o_lang, r.o_datatype) == ("iri", "iri", None, None)
    r = got[("http://ex.org/a", "http://ex.org/label", "tagged")]
    assert (r.o_kind, r.o_lang) == ("literal", "en-GB")
    r = got[("http://ex.org/a", "http://ex.org/n", "42")]
    assert r.o_datatype == "http://www.w3.org/2001/XMLSchema#int"
    assert ("http://ex.org/a", "http://ex.org/q", 'say "hi" <b> and \\ back\nslash é') in got
    r = got[("_:b1", "http://ex.org/p", "_:b2")]
    assert (r.s_kind, r.o_kind) == ("bnode", "bnode")
    assert ("http://ex.org/c", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://ex.org/C") in got


def test_line_counts_and_comment_filter(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    c = T.line_counts(lines).first()
    assert (c.n_lines, c.n_comment, c.n_blank, c.n_triples, c.n_malformed) == (11, 1, 1, 7, 2)
    assert without_comments(lines).count() == 9


def test_statistics(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    t = parse_ntriples(lines)
    subj = {r.s: r.n for r in T.subject_counts(t).collect()}
    assert subj["http://ex.org/a"] == 5
    assert {r["class"]: r.n for r in T.class_counts(t).collect()} == {"http://ex.org/C": 1}
    top = T.top_by_count(T.subject_counts(t), "s", 2).collect()
    assert [r.s for r in top] == ["http://ex.org/a", "_:b1"]
    prev = T.preview(t, 3).collect()
    assert [r.s for r in prev] == ["_:b1", "http://ex.org/a", "http://ex.org/a"]
    assert T.distinct_terms(t).count() == 10
