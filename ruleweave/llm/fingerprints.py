"""Document fingerprints by one-permutation MinHash, with DataFrame functions only.

Every shingle of five words is hashed once.  The top bits of the hash choose one of ``BINS`` bins, and each bin keeps its
smallest hash.  Empty bins are filled by optimal densification: an empty bin tries bins in an order of its own,
which is the same for all texts, until one holds a value (:func:`densified`).  The fingerprint is the lowest ``BITS`` bits
of each bin, packed.  Two values agree by chance once in 2^BITS, so the share of equal cells is corrected for that bias
(:func:`likeness`).

The edited text of a document needs the beginning of the next one.  Documents are put in order by light keys; then a
document's text is grouped by key once, and only the beginnings that are asked for move a second time.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.common import written
from ruleweave.operators.graph import dictionary_encode

K = 5
#: Bins of a fingerprint, a power of two of at most 256, and bits kept of each.
BINS = 256
BITS = 4
#: Bins that an empty bin tries one by one; after so many misses the first one in its order is looked for among those filled.
TRIES = 24
#: Copies of a row that are written at once.
COPIES = 4096
WORD_BITS = 64
# White space between words.
SPACE = "\\x20\\x09-\\x0D"
BLANK = " \t\n\x0b\f\r"


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that later expressions read instead of evaluating it again."""
    return df.withColumn(name, F.explode(F.array(value)))


# ---- sketch ----------------------------------------------------------------------------------------------------

def shingle_hashes(words: Column, k: int = K) -> Column:
    """Hashes of the runs of ``k`` words from the hashes of the words; fewer words are one run, none is no run."""
    n = F.size(words)
    runs = F.transform(F.slice(words, 1, n - (k - 1)), lambda x, i: F.xxhash64(x, *[F.get(words, i + j) for j in range(1, k)]))
    return F.when(n >= k, runs).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.slice(words, 1, 0))


def _shift(bins: int) -> int:
    return WORD_BITS - (bins.bit_length() - 1)


def with_bin_minima(df: DataFrame, name: str, bins: int = BINS) -> DataFrame:
    """``df`` with the hashes of column ``name`` replaced by the smallest one of every bin, null for empty bins.

    Each bin gets its largest value as a mark; after sorting, the first value of a bin is its smallest.
    """
    shift = _shift(bins)
    low = (1 << shift) - 1
    marks = F.lit(np.array([(b - bins // 2) * (1 << shift) + low for b in range(bins)], dtype=np.int64))
    df = _once(df, name, F.sort_array(F.concat(name, marks)))
    bin_of = lambda x: F.shiftright(x, shift)
    return _once(df, name, F.transform(
        F.filter(name, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(name, i - 1)))),
        lambda x: F.when(x.bitwiseAND(F.lit(low)) != low, x)))


def probe_order(bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """First bin and odd step of each bin's order: bin ``i`` tries ``first[i] + a * step[i]`` modulo ``bins``, for a = 0, 1, ..., so every bin once."""
    i = np.arange(1, bins + 1, dtype=np.uint64)
    x = i * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (x % np.uint64(bins)).astype(np.int32), ((x >> np.uint64(32)) % np.uint64(bins)).astype(np.int32) | 1


def densified(minima: Column, bins: int = BINS, tries: int = TRIES) -> Column:
    """``minima`` with each null replaced by the first value in the bin's own order.

    The first ``tries`` bins are looked up one by one.  If all are empty, few bins are filled: then the filled bin
    with the least place in the order, ``(bin - first) / step`` modulo ``bins``, is the same one.
    """
    first, step = probe_order(bins)
    inverse = np.array([pow(int(s), -1, bins) for s in step], dtype=np.int32)
    first, step, inverse = (F.lit(x) for x in (first, step, inverse))
    mask = F.lit(bins - 1)
    shift, half = _shift(bins), bins // 2

    def place(x: Column, i: Column) -> Column:
        at = F.shiftright(x, shift).cast("int") + half
        return ((at - F.get(first, i)) * F.get(inverse, i)).bitwiseAND(mask)

    def nearest(i: Column) -> Column:
        return F.array_min(F.transform(F.array_compact(minima), lambda x: F.struct(place(x, i).alias("p"), x.alias("x"))))["x"]

    def fill(x: Column, i: Column) -> Column:
        looked = [F.get(minima, (F.get(first, i) + F.get(step, i) * a).bitwiseAND(mask)) for a in range(tries)]
        return F.coalesce(x, *looked, nearest(i))

    return F.transform(minima, fill)


def packed(values: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The lowest ``bits`` bits of every value, as an array of 64-bit words."""
    each = WORD_BITS // bits
    groups = F.lit(np.arange(0, bins, each, dtype=np.int32))
    return F.transform(groups, lambda g: F.aggregate(
        F.slice(values, g + 1, each), F.lit(0).cast("long"),
        lambda acc, v: F.shiftleft(acc, bits).bitwiseOR(v.bitwiseAND(F.lit((1 << bits) - 1).cast("long")))))


def with_fingerprint(df: DataFrame, text: Column, name: str, k: int = K, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``df`` with ``name``, the packed words of the text's fingerprint (empty for a text without words)."""
    bare = F.btrim(text, F.lit(BLANK))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))
    df = _once(df, "_w", F.transform(words, lambda w: F.xxhash64(w)))
    df = _once(df, "_n", F.size("_w"))
    df = _once(df, "_s", shingle_hashes(F.col("_w"), k)).drop("_w")
    df = with_bin_minima(df, "_s", bins)
    df = _once(df, "_s", F.when(F.col("_n") > 0, densified(F.col("_s"), bins)))
    none = F.array().cast("array<long>")
    return _once(df, name, F.when(F.col("_n") > 0, packed(F.col("_s"), bins, bits)).otherwise(none)).drop("_s", "_n")


def as_hex(words: Column) -> Column:
    return F.lower(F.array_join(F.transform(words, lambda w: F.lpad(F.hex(w), WORD_BITS // 4, "0")), ""))


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated share of common shingles (0 to 1) from two packed fingerprints.

    The share of equal cells less the cells that agree by chance: ``(equal - c) / (1 - c)`` with ``c = 2^-bits``.  Two texts
    without words are alike (1), one of them and another text are not (0).
    """
    if bits & (bits - 1):
        raise ValueError("bits must be a power of two")
    lowest = sum(1 << at for at in range(0, WORD_BITS, bits))
    ones = F.lit(lowest - (1 << WORD_BITS) if lowest >> (WORD_BITS - 1) else lowest).cast("long")

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        step = bits // 2
        while step:
            d = d.bitwiseOR(F.shiftrightunsigned(d, step))
            step //= 2
        return F.bit_count(d.bitwiseAND(ones))

    apart = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda acc, n: acc + n)
    chance = 2.0 ** -bits
    share = ((bins - apart) / F.lit(float(bins)) - chance) / (1 - chance)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(
        F.greatest(share, F.lit(0.0)))


# ---- documents in order ----------------------------------------------------------------------------------------

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``<k, id, text>``: ``k`` orders the rows by id (nulls first), equal ids by the text's hash; equal rows share it."""
    id_, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    # ids as 16 hex digits that sort like the numbers
    place = F.coalesce(F.lpad(F.hex(id_.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), F.lit(""))
    return docs.select(F.concat(F.rpad(place, 16, "-"), F.md5(text)).alias("k"), id_.alias("id"), text.alias("text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, bins: int = BINS,
                 bits: int = BITS) -> DataFrame:
    """One row per input row: ``<id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next>``.

    The edited text has its last ``floor(n_chars / 4)`` code points replaced by the first as many (or all) of the next document's,
    in ascending order of ids; the first follows the last.  ``near_edited`` and ``near_next`` are the likeness of a
    document's fingerprint to that of its edited text and of the next document, 0 to 1.

    Null text counts as empty; a text without words has an empty fingerprint.  Fewer words than a shingle's are one
    shingle.  Rows of equal id are ordered by their text's hash, null ids come first; of equal rows each is
    followed by the next one.  A single row follows itself.  Other columns are not read.  An empty table gives no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    light = keyed.groupBy("k").agg(F.first("id").alias("id"), F.first(F.length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    ordered = dictionary_encode(light.select(F.col("k").alias("label"))).select(F.col("id").alias("r"), F.col("label").alias("_k"))
    ordered = written(light.join(ordered.hint("merge"), F.col("k") == F.col("_k")).select("r", "k", "id", "n", "copies"), "order")
    total = ordered.count()
    quarter = F.floor(F.col("n") / 4).cast("int")
    # what each document's predecessor asks of it
    asks = ordered.select(F.pmod(F.col("r") + 1, F.lit(max(total, 1))).alias("r"), quarter.alias("q"), F.col("k").alias("asker"), "copies")
    asks = written(ordered.select("r", "k").join(asks.hint("merge"), "r").select(F.col("k").alias("_k"), "q", "asker", "copies"), "asks")

    # equal rows combine before they move; both joins read the same columns, so one exchange of the texts
    texts = keyed.groupBy("k").agg(F.first("text").alias("text"))
    heads = texts.join(asks.hint("merge"), F.col("k") == F.col("_k")).select(
        F.col("asker").alias("_a"), F.substring("text", F.lit(1), F.col("q")).alias("head"), "copies")
    both = texts.join(heads.hint("merge"), F.col("k") == F.col("_a"))
    n = F.length("text")
    cut = (n - F.floor(n / 4)).cast("int")
    # of equal rows all but the last are followed by themselves
    follow = F.array(F.struct(F.lit(1).cast("long").alias("times"), F.col("head").alias("head"), F.lit(False).alias("self")),
                     F.struct((F.col("copies") - 1).alias("times"), F.substring("text", F.lit(1), F.floor(n / 4).cast("int")).alias("head"),
                              F.lit(True).alias("self")))
    both = with_fingerprint(both.select("k", "text", "copies", "head"), F.col("text"), "fp", k, bins, bits)
    both = both.select("k", "text", n.cast("long").alias("n_chars"), "fp", cut.alias("cut"),
                       F.inline(F.filter(follow, lambda f: f["times"] > 0)))
    both = _once(both, "edited", F.concat(F.substring("text", F.lit(1), F.col("cut")), F.col("head"))).drop("text", "head")
    both = with_fingerprint(both, F.col("edited"), "efp", k, bins, bits)
    prints = written(both.select("k", "n_chars", "times", "self", F.sha2("edited", 256).alias("edited_sha256"), "fp", "efp"), "prints")

    nexts = asks.select(F.col("asker").alias("_a"), F.col("_k").alias("_next"))
    follows = prints.join(nexts.hint("merge"), F.col("k") == F.col("_a")).join(
        ordered.select(F.col("k").alias("_o"), "id").hint("merge"), F.col("k") == F.col("_o"))
    other = prints.filter("not self").select(F.col("k").alias("_p"), F.col("fp").alias("next_fp"))
    wanted = F.when(F.col("self"), F.col("k")).otherwise(F.col("_next"))
    out = follows.withColumn("_next", wanted).join(other.hint("merge"), F.col("_next") == F.col("_p"))
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / COPIES))
    out = out.withColumn("_c", F.explode(chunks)).withColumn("_i", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(COPIES), F.col("times") - F.col("_c") * COPIES).cast("int"))))
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("efp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("efp"), bins, bits).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp"), bins, bits).alias("near_next"))
