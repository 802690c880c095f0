"""Text features and classification over a document table ``<doc_id, text>``.

Tokenisers are Spark ML transformers (JVM); empty tokens are dropped so the
arrays are the plain word lists.  Term TF-IDF is a relational plan
(``explode`` + two aggregations + one join) that a SQL engine can check; the
hashed TF-IDF and the logistic-regression pipeline use Spark ML directly.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF, RegexTokenizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ruleweave.functions.numeric import grid_round
from ruleweave.operators.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_small, cut_lineage, materialize
from ruleweave.session import ensure_checkpoint_dir


def _drop_empty(c: str):
    return F.filter(F.col(c), lambda t: t != F.lit(""))


def tokenize_whitespace(docs: DataFrame, text: str = "text", out: str = "tokens") -> DataFrame:
    """Lower-case and split on whitespace (``Tokenizer``); empty tokens dropped."""
    tok = Tokenizer(inputCol=text, outputCol=out)
    return tok.transform(docs).withColumn(out, _drop_empty(out))


def tokenize_regex(docs: DataFrame, text: str = "text", out: str = "tokens", pattern: str = "\\W") -> DataFrame:
    """Lower-case and split on a regex (``RegexTokenizer``, gaps, min length 1)."""
    tok = RegexTokenizer(inputCol=text, outputCol=out, pattern=pattern, gaps=True, toLowercase=True,
                         minTokenLength=1)
    return tok.transform(docs)


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens per document under both tokenisers: ``<key, n_ws, n_regex>``."""
    ws = tokenize_whitespace(docs.select(key, text), text, "_ws")
    both = tokenize_regex(ws, text, "_rx")
    return both.select(key, F.size("_ws").alias("n_ws"), F.size("_rx").alias("n_regex"))


def term_tfidf(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``<key, term, tf, df, idf, tfidf>`` with ``idf = ln((n_docs + 1) / (df + 1))``.

    ``tf`` = occurrences in the document, ``df`` = documents holding the term,
    ``n_docs`` = all documents (a scalar subquery).  ``df`` derives from the
    same ``tf`` aggregation (its shuffle stage is reused: each document is
    tokenised once);
    AQE turns the ``tf ⋈ df`` join into a broadcast only when the measured
    vocabulary is small, otherwise it shuffles on ``term`` and splits hot terms.
    """
    # same tokens as tokenize_whitespace, as one native expression: explode_outer
    # keeps Spark from re-evaluating the split in an inferred pre-filter
    words = F.split(F.lower(F.col(text)), "\\s")
    tf = (docs.select(key, F.explode_outer(words).alias("term")).filter(F.col("term") != "")
          .groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")))
    # documents where the term occurs (tf > 0); reading tf keeps this branch's
    # input identical to the left side, so the tf shuffle stage is reused
    df = tf.groupBy("term").agg(F.count(F.when(F.col("tf") > 0, F.lit(1))).alias("df"))
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    idf = F.log((n_docs.cast("double") + F.lit(1.0)) / (F.col("df").cast("double") + F.lit(1.0)))
    return (
        tf.join(df, "term")
        .select(key, "term", "tf", "df", grid_round(idf).alias("idf"), grid_round(F.col("tf") * idf).alias("tfidf"))
    )


def hashed_tfidf(docs: DataFrame, num_features: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``Tokenizer`` -> ``HashingTF(num_features)`` -> ``IDF`` fit/transform.

    Returns ``<key, features array<double>>`` (dense view of the sparse vector).
    """
    words = Tokenizer(inputCol=text, outputCol="_words").transform(docs.select(key, text))
    raw = HashingTF(inputCol="_words", outputCol="_raw", numFeatures=num_features).transform(words)
    model = IDF(inputCol="_raw", outputCol="_features").fit(raw)
    return model.transform(raw).select(key, vector_to_array("_features").alias("features"))


def count_vectors(docs: DataFrame, vocab_size: int = 1000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``<key, indices array<int>, counts array<long>>``: sparse term counts over a bounded vocabulary.

    The vocabulary holds the ``vocab_size`` terms of largest document frequency, ties by term; a term's index is its place in
    that order.  Only those (a bound given by the caller) leave the tasks.
    A document without a vocabulary term has empty arrays.

    A row is counted where it stands: its distinct terms go into the document frequencies (sums combine before the shuffle),
    then its words meet the vocabulary.  Rows that share a key are one document, counted by a shuffle of their own terms;
    those without a key are one document for the frequencies and have empty arrays.
    """
    words = F.split(F.lower(F.col(text)), "\\s")
    shared, n_shared = materialize(docs.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
                                   .filter((F.col("_n") > 1) | F.col("_key").isNull()).select("_key"))
    single, tf = docs, None
    if n_shared:
        shared = F.broadcast(shared) if n_shared <= DEFAULT_BROADCAST_ROWS else shared
        single = docs.join(shared, F.col(key) == F.col("_key"), "left_anti").filter(F.col(key).isNotNull())
        merged = docs.join(shared, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        tf = (merged.select(key, F.explode_outer(words).alias("term")).filter(F.col("term") != "")
              .groupBy(key, "term").agg(F.count(F.lit(1)).alias("n")))
    terms = single.select(F.explode_outer(F.array_distinct(words)).alias("term")).filter(F.col("term") != "")
    if tf is not None:
        terms = terms.unionByName(tf.select("term"))
    top = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).orderBy(F.col("df").desc(), F.col("term")).limit(vocab_size)
    vocabulary = [r.term for r in top.collect()]
    empty = [F.array().cast("array<int>").alias("indices"), F.array().cast("array<bigint>").alias("counts")]
    if not vocabulary:
        return docs.select(key, *empty)
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_w", outputCol="_v", minTF=1.0)
    found = counter.transform(single.select(key, F.coalesce(words, F.array().cast("array<string>")).alias("_w")))
    found = found.select(key, F.unwrap_udt("_v").alias("_v")).select(
        key, F.col("_v.indices").alias("indices"), F.col("_v.values").cast("array<bigint>").alias("counts"))
    if tf is None:
        return found
    index = docs.sparkSession.createDataFrame(list(enumerate(vocabulary)), "i int, term string")
    held = (tf.join(F.broadcast(index), "term").groupBy(F.col(key).alias("_key"))
            .agg(F.sort_array(F.collect_list(F.struct("i", "n"))).alias("_v")))
    none = F.array().cast("array<struct<i:int,n:bigint>>")
    out = merged.select(key).join(held, F.col(key) == F.col("_key"), "left").withColumn("_v", F.coalesce("_v", none))
    return found.unionByName(out.select(key, F.col("_v.i").alias("indices"), F.col("_v.n").alias("counts")))


def fit_text_classifier(train: DataFrame, text: str = "text", label: str = "label", num_features: int = 1000,
                        max_iter: int = 10, reg_param: float = 0.001, tol: float = 1e-6) -> PipelineModel:
    """``Pipeline(Tokenizer, HashingTF, LogisticRegression)`` fitted on ``<text, label>``.

    The model goes through the checkpoint folder: it comes back without its training summary, which with two classes holds
    the session, and tasks cannot take a session that has observed a write.
    """
    pipe = Pipeline(stages=[
        Tokenizer(inputCol=text, outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="features", numFeatures=num_features),
        LogisticRegression(maxIter=max_iter, regParam=reg_param, tol=tol, labelCol=label, featuresCol="features"),
    ])
    path = f"{ensure_checkpoint_dir(train.sparkSession)}/model-{uuid.uuid4().hex}"
    pipe.fit(train).save(path)
    return PipelineModel.load(path)


def predict(model: PipelineModel, docs: DataFrame, key: str = "doc_id", label: str = "label") -> DataFrame:
    """``<key, label, features array<double>, probability array<double>, prediction>`` for every document (label only if ``docs`` has it)."""
    out = model.transform(docs)
    kept = [label] if label in docs.columns else []
    return out.select(key, *kept, vector_to_array("features").alias("features"),
                      vector_to_array("probability").alias("probability"), "prediction")


INTERCEPT = -1


def coefficients(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """``<class int, feature int, weight double>`` of a fitted classifier; the intercept is feature ``INTERCEPT``.

    A row per class and feature, so its size is set by the model's parameters.  With two classes the fit has weights for
    class 1 alone; class 0 then has an intercept of zero and nothing else.
    """
    lr = model.stages[-1]
    weights, intercepts = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    first = 1 if len(weights) == 1 else 0
    rows = [(0, INTERCEPT, 0.0)] * first
    for c, (row, intercept) in enumerate(zip(weights.tolist(), intercepts.tolist()), start=first):
        rows += [(c, INTERCEPT, intercept), *((c, f, w) for f, w in enumerate(row))]
    return spark.createDataFrame(rows, "class int, feature int, weight double")


def sparse_features(model: PipelineModel, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``<key, feature int, value double>``: the features a document has, and 1.0 for ``INTERCEPT`` in every document."""
    held = PipelineModel(model.stages[:-1]).transform(docs).withColumn("_x", vector_to_array("features"))
    entries = F.filter(F.transform("_x", lambda x, i: F.struct(i.cast("int").alias("feature"), x.alias("value"))),
                       lambda e: e.value != 0)
    constant = F.array(F.struct(F.lit(INTERCEPT).alias("feature"), F.lit(1.0).alias("value")))
    return held.select(key, F.explode(F.concat(constant, entries)).alias("_e")).select(key, "_e.feature", "_e.value")


def class_probabilities(features: DataFrame, weights: DataFrame, key: str = "doc_id") -> DataFrame:
    """``<key, class, probability>`` by joins alone: sparse features meet weights, sums per class, softmax.

    ``key`` must be unique.  Sums combine before the shuffle; the weights are broadcast behind a check of their size.
    """
    scores = (features.join(broadcast_if_small(weights), "feature").groupBy(key, "class")
              .agg(F.sum(F.col("value") * F.col("weight")).alias("_s")))
    whole = Window.partitionBy(key)
    shifted = scores.withColumn("_p", F.exp(F.col("_s") - F.max("_s").over(whole)))
    return shifted.select(key, "class", (F.col("_p") / F.sum("_p").over(whole)).alias("probability"))


def loss_gradient(model: PipelineModel, train: DataFrame, key: str = "doc_id", label: str = "label") -> DataFrame:
    """``<class, feature, gradient double, expected double>``: gradient of the penalised loss at the model's weights.

    The loss is the mean negative log-likelihood plus ``regParam / 2`` times the squared weights of standardised features;
    the gradient is that by those weights (by the plain weight where a feature does not vary), so it is zero in every row
    exactly at the optimum.  ``expected`` is the sum of ``value * probability`` over the documents; for the intercept
    this is the number of documents that the model expects in the class.  ``key`` must be unique.
    """
    spark = train.sparkSession
    weights = coefficients(model, spark)
    free = weights.filter("class > 0") if model.stages[-1].numClasses == 2 else weights
    features = cut_lineage(sparse_features(model, train, key))
    n = train.select(F.count(F.lit(1)).cast("double")).scalar()
    off = class_probabilities(features, weights, key).join(train.select(key, F.col(label).alias("_y")), key).select(
        key, "class", "probability", (F.col("probability") - F.when(F.col("_y") == F.col("class"), 1.0).otherwise(0.0)).alias("_off"))
    moved = features.join(off, key).groupBy("class", "feature").agg(
        F.sum(F.col("value") * F.col("_off")).alias("_g"), F.sum(F.col("value") * F.col("probability")).alias("expected"))
    spread = features.groupBy("feature").agg(F.sum("value").alias("_s1"), F.sum(F.col("value") * F.col("value")).alias("_s2")).select(
        "feature", F.greatest((F.col("_s2") - F.col("_s1") * F.col("_s1") / n) / (n - 1.0), F.lit(0.0)).alias("_var"))
    at = free.join(spread, "feature", "left").join(moved, ["class", "feature"], "left")
    var = F.coalesce("_var", F.lit(0.0))
    unit = F.when(var > 0, F.sqrt(var)).otherwise(1.0)
    slope = F.coalesce("_g", F.lit(0.0)) / n + F.when(F.col("feature") == INTERCEPT, 0.0).otherwise(
        model.stages[-1].getRegParam() * var * F.col("weight"))
    return at.select("class", "feature", (slope / unit).alias("gradient"), F.coalesce("expected", F.lit(0.0)).alias("expected"))
