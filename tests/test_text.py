import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ruleweave.operators import text as X
from ruleweave.operators.sizing import materialize

SENTENCES = [(0, "Boats leave the old harbour"), (1, "Nobody counts seven sleepy grey geese"),
             (2, "salt,pepper,thyme,and,bay")]


def test_tokenizers_and_counts(spark):
    docs = spark.createDataFrame(SENTENCES, "doc_id int, text string")
    ws = {r.doc_id: r.tokens for r in X.tokenize_whitespace(docs).collect()}
    assert ws[0] == ["boats", "leave", "the", "old", "harbour"]
    assert ws[2] == ["salt,pepper,thyme,and,bay"]
    rx = {r.doc_id: r.tokens for r in X.tokenize_regex(docs).collect()}
    assert rx[2] == ["salt", "pepper", "thyme", "and", "bay"]
    counts = {r.doc_id: (r.n_ws, r.n_regex) for r in X.token_counts(docs).collect()}
    assert counts == {0: (5, 5), 1: (6, 6), 2: (1, 5)}


def test_empty_tokens_dropped(spark):
    docs = spark.createDataFrame([(0, "  two   spaces\tand tab "), (1, "é-É x")], "doc_id int, text string")
    ws = {r.doc_id: r.tokens for r in X.tokenize_whitespace(docs).collect()}
    assert ws[0] == ["two", "spaces", "and", "tab"]
    rx = {r.doc_id: r.tokens for r in X.tokenize_regex(docs).collect()}
    assert rx[1] == ["x"]  # \W is ASCII-based


def test_term_tfidf(spark):
    docs = spark.createDataFrame([(0, "a b a"), (1, "b c"), (2, "c c c")], "doc_id int, text string")
    got = {(r.doc_id, r.term): (r.tf, r.df, r.idf, r.tfidf) for r in X.term_tfidf(docs).collect()}
    idf = lambda df: math.log((3 + 1) / (df + 1))
    assert got[(0, "a")][:2] == (2, 1)
    assert got[(0, "a")][3] == pytest.approx(2 * idf(1), abs=1e-6)
    assert got[(2, "c")][3] == pytest.approx(3 * idf(2), abs=1e-6)
    assert len(got) == 5


def test_count_vectors_by_row_and_by_shared_key(spark):
    rows = [(1, "a b  a"), (2, "B c"), (3, None), (4, ""), (5, "zz yy"), (6, "a c"), (6, "c C"), (None, "b q"), (None, "q")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted(((r.doc_id or 0, r.indices, r.counts) for r in X.count_vectors(docs, 3).collect()))
    # documents holding: b 3 (1, 2, keyless), a 2 (1, 6), c 2 (2, 6), q 1
    assert got == [(0, [], []), (0, [], []), (1, [0, 1], [1, 2]), (2, [0, 2], [1, 1]), (3, [], []), (4, [], []), (5, [], []),
                   (6, [1, 2], [1, 3]), (6, [1, 2], [1, 3])]
    assert {f.name: f.dataType.simpleString() for f in X.count_vectors(docs, 3).schema} == {
        "doc_id": "int", "indices": "array<int>", "counts": "array<bigint>"}
    assert X.count_vectors(docs.filter("doc_id in (3, 4)")).filter("size(indices) = 0").count() == 2


def test_count_vectors_do_not_shuffle_terms_of_rows(spark):
    docs = spark.createDataFrame([(i, f"a b{i}") for i in range(5)], "doc_id int, text string")
    plan = X.count_vectors(docs, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


def test_hashed_tfidf_equals_bucketed_term_tfidf(spark):
    from pyspark.ml.feature import HashingTF

    docs = spark.createDataFrame(SENTENCES + [(3, "geese geese thyme")], "doc_id int, text string")
    n = 20
    got = {r.doc_id: r.features for r in X.hashed_tfidf(docs, num_features=n).collect()}
    htf = HashingTF(numFeatures=n)
    toks = {r.doc_id: r.tokens for r in X.tokenize_whitespace(docs).collect()}
    tf = {}
    for d, ts in toks.items():
        for t in ts:
            b = htf.indexOf(t)
            tf[(d, b)] = tf.get((d, b), 0) + 1
    df = {}
    for (d, b) in tf:
        df[b] = df.get(b, 0) + 1
    m = len(toks)
    for (d, b), c in tf.items():
        assert got[d][b] == pytest.approx(c * math.log((m + 1) / (df[b] + 1)))
    assert sum(1 for d in got for x in got[d] if x != 0.0) <= len(tf)


def test_logistic_regression_pipeline(spark):
    train = spark.createDataFrame([(0.0, "boats leave the old harbour"), (1.0, "nobody counts seven sleepy geese"),
                                   (2.0, "salt pepper thyme and bay")], "label double, text string")
    docs = spark.createDataFrame([(0, 2.0, "thyme and salt"), (1, 0.0, "old boats")], "doc_id int, label double, text string")
    model = X.fit_text_classifier(train)
    out = X.predict(model, docs)
    assert out.columns == ["doc_id", "label", "features", "probability", "prediction"]
    for r in out.collect():
        assert r.prediction == r.label and sum(r.probability) == pytest.approx(1.0)
        assert sum(r.features) == len(docs.filter(F.col("doc_id") == r.doc_id).first().text.split())
    assert "label" not in X.predict(model, docs.drop("label")).columns


def test_two_classes_predicted_after_an_observed_write(spark):
    assert materialize(spark.range(3))[1] == 3  # the session now holds its observations
    train = spark.createDataFrame([(0, 0.0, "boats leave the old harbour"), (1, 1.0, "nobody counts seven sleepy geese")],
                                  "doc_id int, label double, text string")
    rows = X.predict(X.fit_text_classifier(train), train).collect()
    assert len(rows) == 2 and all(r.prediction == r.label for r in rows)


@pytest.mark.parametrize("classes", [2, 3])
def test_relational_scores_and_gradient(spark, classes):
    rng = np.random.default_rng(classes)
    rows = [(i, float(y := i % classes), " ".join(f"w{int(w)}" for w in rng.integers(y, 8 + y, 1 + i % 5))) for i in range(60)]
    train = spark.createDataFrame(rows + [(60, 0.0, "")], "doc_id int, label double, text string")
    model = X.fit_text_classifier(train, num_features=16, max_iter=2, reg_param=0.05)
    want = {r.doc_id: r for r in X.predict(model, train).collect()}
    got = X.class_probabilities(X.sparse_features(model, train), X.coefficients(model, spark)).collect()
    assert len(got) == 61 * classes
    assert all(r.probability == pytest.approx(want[r.doc_id].probability[r["class"]], abs=1e-12) for r in got)
    # the gradient by plain arrays
    ids = sorted(want)
    x = np.array([want[i].features for i in ids])
    off = np.array([want[i].probability for i in ids]) - np.eye(classes)[[int(want[i].label) for i in ids]]
    unit = np.where(x.std(0, ddof=1) > 0, x.std(0, ddof=1), 1.0)
    lr = model.stages[-1]
    first = 1 if classes == 2 else 0
    slope = {(c, X.INTERCEPT): off[:, c].mean() for c in range(first, classes)}
    for c in range(first, classes):
        data = off[:, c] @ x / len(ids) + 0.05 * x.var(0, ddof=1) * lr.coefficientMatrix.toArray()[c - first]
        slope |= {(c, f): v for f, v in enumerate(data / unit)}
    rows = X.loss_gradient(model, train).collect()
    found = {(r["class"], r.feature): r.gradient for r in rows}
    assert sorted(found) == sorted(slope)
    assert all(found[k] == pytest.approx(slope[k], abs=1e-12) for k in slope)
    assert max(map(abs, found.values())) > 1e-3  # two rounds do not reach the optimum
    best = X.fit_text_classifier(train, num_features=16, max_iter=500, reg_param=0.05, tol=1e-12)
    assert max(abs(r.gradient) for r in X.loss_gradient(best, train).collect()) < 1e-5
