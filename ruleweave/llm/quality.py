"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Only DataFrame functions.  Word unigrams and bigrams of every text are hashed
into ``buckets`` cells.  Two multinomials are counted over all rows: the raw
corpus, and the rows marked as trusted.  A text's score is the mean over its
n-grams of ``log p_target - log p_raw`` (add-one smoothed, on a grid of 2**-20 so
that sums are exact in any order); it is kept if its base rules hold and the score
reaches the threshold.  Counts shuffle as partial sums of at most ``buckets`` cells
per map task; the weights (exactly ``buckets`` rows at most) are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.llm.common import written

BUCKETS = 1 << 16
GRID = float(1 << 20)
#: Steps of the score at which thresholds are tried.
STEP = 1 / 64
WINDOW = 8

# White space between words.
SPACE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    """Words of a text: longest runs without white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def hashed_words(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_w`` (words), ``_h1`` (their hashes) and ``_h2`` (hashes of neighbouring pairs), each evaluated once."""
    return (docs.withColumn("_w", F.explode(F.array(words(text))))
            .withColumn("_h1", F.transform("_w", lambda x: F.xxhash64(x)))
            .withColumn("_h1", F.explode(F.array("_h1")))
            .withColumn("_h2", F.transform(F.slice("_h1", 1, F.greatest(F.size("_h1") - 1, F.lit(0))),
                                           lambda h, i: F.xxhash64(h, F.get("_h1", i + 1))))
            .withColumn("_h2", F.explode(F.array("_h2"))))


def repeated_words(h2: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that the text holds twice or more, from its pair hashes.

    Windows are compared by 64-bit hashes, doubled from pairs to four and eight words.  Texts whose
    runs of four words all differ stop there, then those whose windows all differ; else windows are
    sorted by hash, those equal to a neighbour are the repeated ones, and the stretches they
    cover are summed.
    """
    def doubled(h: Column, step: int) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - step, F.lit(0))),
                           lambda x, i: F.xxhash64(x, F.get(h, i + step)))

    differ = lambda h: F.size(F.array_distinct(h)) == F.size(h)

    def covered(h8: Column) -> Column:
        pairs = F.sort_array(F.transform(h8, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _bind(pairs, lambda p: _bind(F.sort_array(repeated(p)), lambda at: F.aggregate(
            # stretch of a window: up to the next repeated window's start, WINDOW words at most
            F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x)))

    def repeated(p: Column) -> Column:
        near = lambda i: F.get(p, i)["h"]
        hit = F.transform(p, lambda x, i: F.when((x["h"] == near(i - 1)) | (x["h"] == near(i + 1)), x["i"]))
        return F.filter(hit, lambda i: i.isNotNull())

    return _bind(doubled(h2, 2), lambda h4: F.when(differ(h4), F.lit(0)).otherwise(
        _bind(doubled(h4, 4), lambda h8: F.when(differ(h8), F.lit(0)).otherwise(covered(h8))))).cast("long")


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def cell(buckets: int = BUCKETS) -> Column:
    """Cell of the n-gram hash ``_h``."""
    return F.pmod(F.col("_h"), F.lit(buckets)).cast("int")


def grams() -> Column:
    """Hashes of all unigrams and bigrams."""
    return F.concat("_h1", "_h2")


def base_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with hashed words, the base columns and ``base_failed``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    return (hashed_words(docs, text)
            .withColumn("_lines", F.explode(F.array(lines)))
            .withColumn("n_words", F.size("_w").cast("long"))
            .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
            .withColumn("n_symbols", F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("n_repeat_words", F.explode(F.array(repeated_words(F.col("_h2")))))
            .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))))


def cell_counts(docs: DataFrame, buckets: int, name: str) -> DataFrame:
    """``<cell, name>``: n-grams of all texts by cell."""
    every = hashed_words(docs, F.col("_text")).select(F.explode(grams()).alias("_h"))
    return every.select(cell(buckets).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias(name))


def fold_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """``<cell, t0, t1>``: n-grams of the texts of both folds by cell."""
    every = hashed_words(docs.withColumn("_fold", fold(text_hash(F.col("_text")))), F.col("_text"))
    return every.select("_fold", F.explode(grams()).alias("_h")).select("_fold", cell(buckets).alias("cell")).groupBy("cell").agg(
        F.count_if(F.col("_fold") == 0).alias("t0"), F.count_if(F.col("_fold") == 1).alias("t1"))


def weights(counts: DataFrame) -> DataFrame:
    """``<cell, w, w0, w1>`` from ``<cell, raw, t0, t1>``: log ratios of the smoothed multinomials, in steps of the grid.

    ``w`` counts the target on both folds; ``w0`` and ``w1``, for texts of that fold, on the other one.
    """
    n_raw, n0, n1, k = (counts.select(x).scalar() for x in (F.sum("raw"), F.sum("t0"), F.sum("t1"), F.count(F.lit(1))))

    def ratio(target: Column, n_target: Column) -> Column:
        r = F.log((target + 1) / (n_target + k)) - F.log((F.col("raw") + 1) / (n_raw + k))
        return F.round(r * GRID).cast("long")

    return counts.select("cell", ratio(F.col("t0") + F.col("t1"), n0 + n1).alias("w"), ratio(F.col("t1"), n1).alias("w0"),
                         ratio(F.col("t0"), n0).alias("w1"))


def score_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  buckets: int = BUCKETS, threshold: float | None = None) -> DataFrame:
    """One row per input row: id, base columns, ``base_failed``, ``kept``, ``llr``, ``threshold``, ``text_hash``.

    ``trusted`` is ``<id, quality>`` (1 trusted, 0 rejected, others unused); its
    ids mark rows of ``docs``.  An id marked both ways counts as rejected.  The target is
    counted on all trusted texts.  With no threshold given it is fitted on the marked texts that pass the
    base rules, in two folds by text hash: each is scored with the target counted on the other fold, so its own
    n-grams are not in the target, just like an unmarked row's: the step of the score at which the shares of trusted rows
    kept and rejected rows dropped have the largest sum, the lowest of equals; without
    rows of both kinds nothing is dropped by score.

    Null text: no words, so the base rules fail.  A text without n-grams scores 0.
    Repeated rows are scored one by one; rows with a null id are never marked.
    Other columns are not read.
    """
    marks = (trusted.select(F.col(id_col).alias("_mark"), "quality").filter(F.col("quality").isin(0, 1))
             .groupBy("_mark").agg(F.min("quality").alias("_quality")))
    rows = base_rules(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text")
    rows = rows.select("_id", text_hash(F.col("_text")).alias("text_hash"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "_h1", "_h2")

    slim = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    # the corpus is counted where it lies; only texts that may be in the target meet the marks
    raw = cell_counts(slim, buckets, "raw")
    good = marks.filter("_quality = 1").select("_mark")
    target = fold_counts(slim.join(good.hint("merge"), F.col("_id") == F.col("_mark"), "left_semi"), buckets)
    model = weights(written(raw.join(target, "cell", "left").na.fill(0, ["t0", "t1"]), "cells"))

    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    keys = ["_row", "_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    scored = (numbered.select(*keys, F.explode_outer(grams()).alias("_h")).select(*keys, cell(buckets).alias("cell"))
              .join(F.broadcast(model), "cell", "left")
              .groupBy(*keys).agg(F.sum("w").alias("_sum"), F.count("cell").alias("_n"),
                                  F.sum(F.when(fold(F.col("text_hash")) == 0, F.col("w0")).otherwise(F.col("w1"))).alias("_other")))
    mean = lambda c: F.when(F.col("_n") > 0, F.col(c) / F.col("_n") / GRID).otherwise(0.0)
    scored = written(scored.withColumn("llr", mean("_sum")).withColumn("llr_other", mean("_other")), "scores")
    if threshold is None:
        cut = fitted_threshold(scored, marks).scalar()
    else:
        cut = F.lit(float(threshold))
    out = scored.withColumn("threshold", cut)
    return out.select(F.col("_id").alias(id_col), *keys[3:], (~F.col("base_failed") & (F.col("llr") >= F.col("threshold"))).alias("kept"),
                      "llr", "threshold", "text_hash")


def fold(hash_: Column) -> Column:
    """Fold 0 or 1 of a text."""
    return F.pmod(hash_, F.lit(2))


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_good(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that :func:`score_quality` keeps (the verdict on a row depends on its text alone).

    Null and empty texts fail the base rules and go; equal texts share one verdict, so repeated rows stay or go together.
    All columns of ``docs`` are kept, whatever their names; an empty table stays empty.
    """
    scored = score_quality(docs, trusted, id_col, text_col, **options)
    kept = scored.filter("kept").select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_id"]) & (text_hash(docs[text_col]) == kept["_hash"]), "left_semi")


def fitted_threshold(scored: DataFrame, marks: DataFrame) -> DataFrame:
    """One row ``<threshold>``: the best step over the marked rows, each scored by the other fold (a histogram of the score, its size fixed by the range of log ratios)."""
    marked = scored.filter(~F.col("base_failed")).join(marks, F.col("_id") == F.col("_mark"))
    steps = marked.groupBy(F.floor(F.col("llr_other") / STEP).alias("step")).agg(
        F.sum(F.col("_quality")).alias("good"), F.sum(1 - F.col("_quality")).alias("bad"))
    below = steps.select("step", "good", "bad").alias("s")
    order = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    gain = below.select(
        "step",
        F.sum("good").over(every).alias("_good"), F.sum("bad").over(every).alias("_bad"),
        F.coalesce(F.sum("good").over(order), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("bad").over(order), F.lit(0)).alias("cut"))
    best = gain.filter((F.col("_good") > 0) & (F.col("_bad") > 0)).select(
        "step", (F.col("cut") / F.col("_bad") - F.col("lost") / F.col("_good")).alias("gain"))
    best = best.agg(F.min(F.struct(-F.col("gain"), F.col("step"))).alias("b"))
    return best.select(F.coalesce(F.col("b.step") * STEP, F.lit(float("-inf"))).alias("threshold"))
