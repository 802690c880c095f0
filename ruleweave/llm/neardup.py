"""Near-duplicate classes by Order MinHash and banded alignment.

Sketch: k-mers are runs of words, labelled with their occurrence number in the text; five words, fewer in texts of less than 128
words, where an edit would touch most runs of five (:func:`scheme`).  Each of the sketch's hash functions picks the ``PICKS``
smallest labelled k-mers and keeps them in the order in which they stand in the text, so equal sketches need common
k-mers *in common order*; this follows edit similarity.  Texts that share a sketch and a length class are a bucket.

Search: first rounds that join large groups cheaply: in every bucket all members are compared with one leader, and linked
classes merge; this goes on while a fair share of the pairs are links.  Then every bucket that still holds several classes is
compared in groups of bounded size (:func:`grouped`): a task holds a group's members, rules pairs out by length and by bags of
words, and aligns the rest unless they are already in one class.  Only members that may have a partner bring their
texts, and only links leave the task: no pairs are written.  Members of a bucket's largest class meet the bucket's other
members only, and a pair with several common buckets is compared in the largest of them: a member stays out of a bucket
where all its pairs belong to larger ones (:func:`owning`).  So the classes do not depend on where the rounds end.

Verification: edit similarity of the word sequences, ``1 - distance / longer length``, at least ``similarity``; the
distance comes from a bit-parallel alignment inside the band that this threshold allows.  Classes are the
connected components of verified links.  Equal texts are one node from the start.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.llm.common import map_slices, share_code, written
from ruleweave.operators.graph import connected_components
from ruleweave.operators.skew import lookup_join

K = 5
SIMILARITY = 0.8
SKETCHES = 64
PICKS = 2
#: Cells of a text's bag of hashed words: at least, and at most for long texts.
BAG = 256
BAG_MOST = 4096
#: Members and words of a group that is compared in one task, about, and members compared with a leader in one go.
GROUP = 1024
GROUP_WORDS = 1 << 20
LED = 256
#: Rounds with leaders go on while this share of the compared pairs are links.
YIELD = 0.2
#: Members of a bucket from which it counts as hot.
HOT = 100_000
#: Members up to which buckets are ordered by size, and bits of a bucket's hash that are kept in this order.
ORDERED = 1 << 20
BUCKET_BITS = 42
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


def words_of(text: str) -> list[str]:
    return WORD.findall(text)


# ---- sketches --------------------------------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (shifts and odd multipliers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of words, remembered within a bound."""

    def __init__(self, limit: int = 400_000):
        self.known: dict[str, int] = {}
        self.limit = limit

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(words):
            if w not in known:
                raw = w.encode()
                known[w] = zlib.crc32(raw) | zlib.adler32(raw[::-1] + b"\1") << 32
        return _mix(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)))


def kmers(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the labelled k-mers of a word sequence, in text order (shorter texts are one k-mer)."""
    n = len(hashes) - k + 1
    if n < 1:
        grams = np.array([_fold(hashes)], dtype=np.uint64)
    else:
        grams = np.zeros(n, dtype=np.uint64)
        for i in range(k):
            grams = _mix(grams + hashes[i:i + n] * np.uint64(2 * i + 3))
    order = np.argsort(grams, kind="stable")
    sorted_ = grams[order]
    start = np.ones(len(grams), bool)
    start[1:] = sorted_[1:] != sorted_[:-1]
    at = np.arange(len(grams))
    nth = np.empty(len(grams), np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(start, at, 0))
    return _mix(grams + nth * np.uint64(0x9E3779B97F4A7C15))


def _fold(hashes: np.ndarray) -> np.uint64:
    out = np.zeros(1, np.uint64) + np.uint64(len(hashes))
    for h in hashes:
        out = _mix(out + h)
    return out[0]


def seeds(sketches: int) -> np.ndarray:
    return _mix(np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def sketch(grams: np.ndarray, seed: np.ndarray, picks: int = PICKS) -> np.ndarray:
    """One 64-bit value per hash function: its ``picks`` smallest k-mers, in text order."""
    picks = min(picks, len(grams))
    out = np.empty(len(seed), np.uint64)
    step = max(1, 1 << 16 >> len(grams).bit_length())
    for lo in range(0, len(seed), step):  # a few functions at a time bound the memory of long texts
        s = seed[lo:lo + step]
        h = (grams[None, :] ^ (s[:, None] << np.uint64(1))) * s[:, None]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
        at, rows = np.empty((len(s), picks), np.int64), np.arange(len(s))
        for c in range(picks):
            at[:, c] = least = h.argmin(1)
            h[rows, least] = np.uint64(MASK)
        at.sort(1)
        v = s.copy()
        for c in range(picks):
            v = _mix(v + grams[at[:, c]])
        out[lo:lo + step] = v
    return out


def scheme(length_class: int, sketches: int = SKETCHES, k: int = K) -> tuple[int, int]:
    """Words of a k-mer and sketches for texts of ``2^length_class`` words and more.

    With a fifth of the words replaced at random a run of five survives with probability 0.33; in short texts few or none do, so
    they take runs of two (under 32 words) or three (under 128), of which half as many sketches find as much.
    """
    if length_class >= 7:
        return k, sketches
    return min(k, 3 if length_class >= 5 else 2), sketches // 2


def bag(hashes: np.ndarray) -> bytes:
    """Counts of hashed words, 255 at most, in a number of cells that follows the length."""
    cells = BAG
    while cells < min(len(hashes) // 2, BAG_MOST):
        cells *= 4
    return np.minimum(np.bincount((hashes % np.uint64(cells)).astype(np.int64), minlength=cells), 255).astype(np.uint8).tobytes()


def length_classes(n: int, similarity: float) -> list[int]:
    """A class spans a doubling of the length; a text so short within its class that it may match one of the class below is in both."""
    c = n.bit_length() - 1
    return [c, c - 1] if c and n * similarity < 1 << c else [c]


def text_buckets(hashes: np.ndarray, seed: np.ndarray, similarity: float = SIMILARITY, picks: int = PICKS, k: int = K) -> np.ndarray:
    """The buckets of a text from the hashes of its words: one per sketch and length class."""
    found = []
    for c in length_classes(len(hashes), similarity):
        width, many = scheme(c, len(seed), k)
        found.append(_mix(sketch(kmers(hashes, width), seed[:many], picks) + np.uint64(c)))
    return np.concatenate(found)


def buckets(texts: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES, picks: int = PICKS, k: int = K) -> DataFrame:
    """``<bucket, node, n_words>``: one row per sketch and length class of every text with words."""
    def make():
        hasher, seed = Hasher(), seeds(sketches)

        def fn(nodes, of):
            out = [[], [], []]
            for node, t in zip(nodes, of):
                ws = words_of(t)
                if not ws:
                    continue
                out[0].append(node)
                out[1].append(len(ws))
                out[2].append(text_buckets(hasher(ws), seed, similarity, picks, k).view(np.int64))
            return out

        return fn

    each = map_slices(texts.select("node", "text"), make, "node bigint, n_words int, sketch array<bigint>")
    return each.select(F.explode("sketch").alias("bucket"), "node", "n_words")


def bags(texts: DataFrame) -> DataFrame:
    """``<node, bag>``."""
    def make():
        hasher = Hasher()
        return lambda nodes, of: [nodes, [bag(hasher(words_of(t))) for t in of]]

    return map_slices(texts.select("node", "text"), make, "node bigint, bag binary")


# ---- alignment -------------------------------------------------------------------------------------------------

def banded_distance(a: list, b: list, limit: int) -> int:
    """Edit distance of two sequences if it is at most ``limit``, else ``limit + 1``.

    Common ends are cut off; the rest is aligned bit-parallel: one integer holds the vertical differences of the
    ``2 * limit + 1`` cells around the diagonal, and moves down a cell with each column.
    """
    if len(a) > len(b):
        a, b = b, a
    at, end = 0, len(a)
    while at < end and a[at] == b[at]:
        at += 1
    shift = len(b) - len(a)
    while end > at and a[end - 1] == b[end - 1 + shift]:
        end -= 1
    a, b, cap = a[at:end], b[at:end + shift], limit + 1
    if shift > limit:
        return cap
    if not a:
        return len(b)
    limit = min(limit, len(b))
    m, width = len(a), 2 * limit + 2
    full, low = (1 << width) - 1, 1 << (width - 1)
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    # in column j the top bit is row j + limit, the lower edge of the band; rows up to 0 have no vertical difference
    vp, vn = full ^ ((1 << (width - 1 - limit)) - 1), 0
    dist = min(limit, m)  # of column 0, at the band's lower edge or the last row
    for j, y in enumerate(b, 1):
        above = j + limit - width  # rows of `a` before bit 0
        eq = where.get(y, 0)
        eq = (eq >> above if above >= 0 else eq << -above) & full
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & full
        hp = vn | (full & ~(d0 | vp))
        hn = d0 & vp
        past = j + limit - m  # rows between the last one and the lower edge
        if past <= 0:
            dist += not d0 & low
        else:
            bit = low >> past
            dist += (hp & bit > 0) - (hn & bit > 0)
        vp = hn | (full & ~(d0 >> 1 | hp))  # one row down for the next column
        vn = d0 >> 1 & hp
    return dist if dist <= limit else cap


def edit_similarity(a: list, b: list, least: float = SIMILARITY) -> float | None:
    """``1 - distance / longer length`` if at least ``least``, else None."""
    n = max(len(a), len(b))
    if not n:
        return 1.0
    limit = int((1 - least) * n + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return None
    if n - sum((Counter(a) & Counter(b)).values()) > limit:  # words that differ as bags differ in any alignment
        return None
    d = banded_distance(a, b, limit)
    return None if d > limit else 1 - d / n


def unfolded(raw: list[bytes]) -> np.ndarray:
    """Bags as rows of one matrix; cells of larger bags are added up to the smallest one's number."""
    cells = min(map(len, raw))
    return np.stack([np.frombuffer(r, np.uint8).reshape(-1, cells).sum(0, dtype=np.int32) for r in raw])


def near_bags(one: np.ndarray, n_one: int, others: np.ndarray, n_others: np.ndarray, similarity: float) -> np.ndarray:
    """Which of ``others`` lengths and bags of hashed words do not rule out.

    One edit takes away or adds one word at most on each side, so the words that one bag has more than the other, cell
    by cell, bound the distance from below; cells that are full only lower the bound.
    """
    limit = ((1 - similarity) * np.maximum(n_one, n_others) + 1e-9).astype(np.int64)
    fit = np.abs(n_others - n_one) <= limit
    at = np.flatnonzero(fit)
    if len(at):
        more = others[at] - one
        fit[at] = np.maximum(np.maximum(more, 0).sum(1), np.maximum(-more, 0).sum(1)) <= limit[at]
    return fit


# ---- comparison in groups --------------------------------------------------------------------------------------

def _by_group(rows: DataFrame, keys: list[str], order: list[str], compare: Callable[[tuple, list[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """Hands the rows of a group, in order, to ``compare``; groups are bounded by how they are made."""
    share_code(rows.sparkSession)
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.float64() if f.split()[1] == "double" else pa.int64() for f in schema.split(", ")]
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, out = None, [], []

        def flushed():
            rows_ = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows_, kinds)], names=names)

        for part in batches:
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if row[:n] != at:
                    if held:
                        out += compare(at, held)
                    at, held = row[:n], []
                held.append(row[n:])
                if len(out) >= 10_000:
                    yield flushed()
        if held:
            out += compare(at, held)
        if out:
            yield flushed()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def led(pairs: DataFrame, values: DataFrame, value: str, near: Callable, schema: str) -> DataFrame:
    """``near(leader's row, members' rows)`` over pairs ``<a, na, b, nb>`` of a leader and a member, whose ``value`` comes from ``values`` ``<node, value>``.

    A leader's members are dealt into groups of about ``LED``; the leader's value goes once to each.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / LED).cast("int").alias("_deals")).select(F.col("a").alias("_a"), "_deals")
    dealt = pairs.join(many.hint("merge"), F.col("a") == F.col("_a")).select(
        "a", F.pmod(F.xxhash64("b", F.lit(3)), F.col("_deals")).cast("int").alias("deal"), "na", "b", "nb")
    keyed = values.select(F.col("node").alias("_v"), value)
    members = dealt.join(keyed.hint("merge"), F.col("b") == F.col("_v")).select("a", "deal", F.lit(1).alias("side"), "b", "nb", value)
    leaders = dealt.select("a", "deal", "na").distinct().join(keyed.hint("merge"), F.col("a") == F.col("_v")).select(
        "a", "deal", F.lit(0).alias("side"), F.col("a").alias("b"), F.col("na").alias("nb"), value)

    def compare(key, rows):
        (_, a, na, x), others = rows[0], rows[1:]
        return near(a, na, x, [r[1] for r in others], np.array([r[2] for r in others], np.int64), [r[3] for r in others])

    return _by_group(members.unionByName(leaders), ["a", "deal"], ["side"], compare, schema)


def plausible(pairs: DataFrame, bag_of: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``<a, na, b, nb>`` whose bags do not rule the similarity out."""
    def near(a, na, x, nodes, lengths, raw):
        every = unfolded([x, *raw])
        for i in np.flatnonzero(near_bags(every[0], na, every[1:], lengths, similarity)).tolist():
            yield a, na, nodes[i], int(lengths[i])

    return led(pairs, bag_of, "bag", near, "a bigint, na bigint, b bigint, nb bigint")


def verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links ``<a, b, similarity>``: the pairs ``<a, na, b, nb>`` whose texts are similar enough."""
    def near(a, na, x, nodes, lengths, of):
        mine = words_of(x)
        for b, t in zip(nodes, of):
            s = edit_similarity(mine, words_of(t), similarity)
            if s is not None:
                yield a, b, s

    return led(pairs, texts, "text", near, "a bigint, b bigint, similarity double")


def by_size(bucket: str, n: str) -> Column:
    """Numbers of buckets of ``n`` members, larger buckets first; buckets that meet in a number are compared as one."""
    smaller = F.lit(ORDERED).cast("long") - F.least(F.col(n), F.lit(ORDERED))
    return F.shiftleft(smaller, BUCKET_BITS).bitwiseOR(F.col(bucket).bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)))


def owning(members: DataFrame) -> DataFrame:
    """``members`` without rows in buckets that own no pair of theirs; ``first`` is a node's first bucket.

    A pair belongs to its first common bucket, so two members with the same first bucket meet there and nowhere else.  Where all members
    outside a bucket's largest class have one first bucket, those of that class with the same one stay out, and the
    bucket goes if that is all of them.
    """
    per = written(members.groupBy("bucket", "cls").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("lo"), F.max("first").alias("hi")), "parts")
    whole = per.groupBy("bucket").agg(F.max_by("cls", F.struct("n", "cls")).alias("_big"), F.sum("n").alias("_m"),
                                      (F.min("lo") == F.max("hi")).alias("_same")).withColumnRenamed("bucket", "_b")
    whole = written(whole, "buckets")
    hot = whole.filter(F.col("_m") > HOT).select(F.col("_b").alias("_hk"), F.ceil(F.col("_m") / HOT).cast("int").alias("_ns"))
    rest = lookup_join(per, whole, "bucket", "_b", lookup_small=False, hot=hot).filter("cls != _big").groupBy(F.col("bucket").alias("_b")).agg(
        F.first("_big").alias("_big"), F.first("_same").alias("_same"), F.min("lo").alias("_only"), F.max("hi").alias("_hi"))
    alike = rest.filter("_only = _hi and _only != _b").drop("_hi")
    met = lookup_join(members, alike, "bucket", "_b", "left", lookup_small=False, hot=hot)
    kept = F.col("_only").isNull() | ~F.col("_same") & ((F.col("cls") != F.col("_big")) | (F.col("first") != F.col("_only")))
    return met.filter(kept).select("bucket", "node", "n_words", "cls")


def grouped(members: DataFrame, most: int = GROUP, words: int = GROUP_WORDS) -> DataFrame:
    """``<bucket, node, n_words, cls, groups>``: the members of buckets of several classes and their places ``<kind, i, j, side>`` in groups of bounded size.

    A bucket of at most ``most`` members (fewer of long texts) is one group, compared within (side 2).  A larger one is dealt into
    blocks, those of its largest class apart from the rest; every block of the rest meets itself, every other one of the
    rest and every one of the largest class (sides 0 and 1).
    """
    per = members.groupBy("bucket", "cls").agg(F.count(F.lit(1)).alias("n"), F.max("n_words").alias("longest"))
    info = per.groupBy("bucket").agg(F.max_by("cls", F.struct("n", "cls")).alias("_big"), F.max("n").alias("_nb"), F.sum("n").alias("_m"),
                                     F.count(F.lit(1)).alias("_classes"), F.max("longest").alias("_long")).filter("_classes > 1")
    size = F.least(F.lit(most), F.greatest(F.lit(16), F.floor(words / F.col("_long"))))
    info = info.select(F.col("bucket").alias("_b"), "_big", "_m", (F.col("_m") <= size).alias("_whole"),
                       F.ceil(F.col("_nb") / size).cast("int").alias("_bigs"), F.ceil((F.col("_m") - F.col("_nb")) / size).cast("int").alias("_rest"))
    info = written(info, "buckets")
    hot = info.filter(F.col("_m") > HOT).select(F.col("_b").alias("_hk"), F.ceil(F.col("_m") / HOT).cast("int").alias("_ns"))
    rows = lookup_join(members, info, "bucket", "_b", lookup_small=False, hot=hot)
    in_big = F.col("cls") == F.col("_big")
    x = F.pmod(F.xxhash64("node", F.lit(5)), F.when(in_big, F.col("_bigs")).otherwise(F.col("_rest"))).cast("int").alias("x")
    rows = rows.withColumn("_x", x)
    place = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))
    within, left, right, zero = F.lit(2), F.lit(0), F.lit(1), F.lit(0)
    meets_rest = F.transform(F.sequence(zero, F.col("_rest") - 1), lambda z: place("b", F.col("_x"), z, left))
    meets_big = F.transform(F.sequence(zero, F.col("_bigs") - 1), lambda z: place("b", z, F.col("_x"), right))
    meets = F.transform(F.sequence(zero, F.col("_rest") - 1), lambda z: place(
        "r", F.least(z, F.col("_x")), F.greatest(z, F.col("_x")), F.when(z == F.col("_x"), within).when(F.col("_x") < z, left).otherwise(right)))
    groups = F.when(F.col("_whole"), F.array(place("w", zero, zero, within))).when(in_big, meets_rest).otherwise(F.concat(meets, meets_big))
    return rows.select("bucket", "node", "n_words", "cls", groups.alias("groups"))


class _Joined:
    """Union-find over class numbers."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)


def _candidates(rows: list[tuple], similarity: float) -> Iterator[tuple[int, int]]:
    """Pairs of rows ``(side, bucket, node, n_words, cls, shared, bag, ...)`` of one group that are to be aligned.

    A pair in several common buckets belongs to the one of smallest number.
    """
    every = unfolded([r[6] for r in rows])
    side, lengths, cls = (np.array([r[i] for r in rows], np.int64) for i in (0, 3, 4))
    first = np.array([min(r[5]) for r in rows], np.int64)
    shared = [None] * len(rows)
    bucket = rows[0][1]

    def of(i: int) -> set:
        if shared[i] is None:
            shared[i] = set(rows[i][5])
        return shared[i]

    for i in range(len(rows)):
        # within a group each pair once, else left ones with right ones (rows come by side)
        at = np.arange(i + 1, len(rows)) if side[i] == 2 else np.flatnonzero(side == 1) if side[i] == 0 else np.arange(0)
        at = at[(cls[at] != cls[i]) & ((first[at] != first[i]) | (first[i] == bucket))]
        if len(at):
            for j in at[near_bags(every[i], int(lengths[i]), every[at], lengths[at], similarity)].tolist():
                if min(of(i) & of(j)) == bucket:
                    yield i, j


def remaining_links(members: DataFrame, texts: DataFrame, bag_of: DataFrame, similarity: float, most: int = GROUP) -> DataFrame:
    """Links ``<a, b, similarity>`` between members ``<bucket, node, n_words, cls>`` of different classes, enough to join all classes that have one."""
    mixed = members.groupBy("bucket").agg(F.min("cls").alias("_lo"), F.max("cls").alias("_hi"), F.count(F.lit(1)).alias("_m")).filter("_lo < _hi")
    members = members.join(mixed.select("bucket", "_m").hint("merge"), "bucket").select(by_size("bucket", "_m").alias("bucket"), "node", "n_words", "cls")
    # a node's buckets: two per sketch at most
    members = written(members.withColumn("first", F.min("bucket").over(Window.partitionBy("node"))), "mixed")
    members = written(owning(members), "owned")
    shared = members.groupBy("node").agg(F.collect_set("bucket").alias("shared"))
    light = bag_of.join(shared.hint("merge"), "node").select(F.col("node").alias("_n"), "shared", "bag")
    # a row for each member of a bucket meets its bag; only then it is dealt to the groups
    dealt = grouped(members, most).join(light.hint("merge"), F.col("node") == F.col("_n")).select("*", F.explode("groups").alias("_g"))
    rows = written(dealt.select(F.xxhash64("bucket", "_g.kind", "_g.i", "_g.j").alias("gid"), F.col("_g.side").alias("side"),
                                "bucket", "node", "n_words", "cls", "shared", "bag"), "groups")

    def wanted(key, held):
        need = set()
        for i, j in _candidates(held, similarity):
            need |= {i, j}
        for i in need:
            yield key[0], held[i][2]

    order = ["side", "node"]
    need = written(_by_group(rows, ["gid"], order, wanted, "_gid bigint, _node bigint"), "wanted")
    with_text = rows.join(need.hint("merge"), (F.col("gid") == F.col("_gid")) & (F.col("node") == F.col("_node"))).drop("_gid", "_node").join(
        texts.select(F.col("node").alias("_n"), "text").hint("merge"), F.col("node") == F.col("_n")).drop("_n")

    def linked(key, held):
        joined, words = _Joined(), [None] * len(held)

        def of(i: int) -> list:
            if words[i] is None:
                words[i] = words_of(held[i][7])
            return words[i]

        for i, j in _candidates(held, similarity):
            x, y = held[i][4], held[j][4]
            if joined.find(x) != joined.find(y):
                s = edit_similarity(of(i), of(j), similarity)
                if s is not None:
                    joined.join(x, y)
                    yield held[i][2], held[j][2], s

    return _by_group(with_text, ["gid"], order, linked, "a bigint, b bigint, similarity double")


# ---- search ----------------------------------------------------------------------------------------------------

def text_node(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(1))


def led_pairs(rest: DataFrame, similarity: float, turn: int) -> DataFrame:
    """``<a, na, b, nb>``: of the leaders of a member's buckets the one to compare it with, of another class and a length the threshold allows.

    A bucket's leader is the first by a hash that changes with the round, so buckets that overlap tend to share it.  A member
    meets one leader a round, that of most of its buckets: a round has at most a pair for each member, whatever the groups.
    """
    first = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("a"), F.col("n_words").alias("na"), F.col("cls").alias("ca"))
    lead = written(rest.groupBy("bucket").agg(F.min(first).alias("lead"), F.count(F.lit(1)).alias("_m"))
                   .select(F.col("bucket").alias("_b"), "lead.a", "lead.na", "lead.ca", "_m"), "leaders")
    hot = lead.filter(F.col("_m") > HOT).select(F.col("_b").alias("_hk"), F.ceil(F.col("_m") / HOT).cast("int").alias("_ns"))
    met = lookup_join(rest, lead, "bucket", "_b", lookup_small=False, hot=hot).filter(F.col("cls") != F.col("ca"))
    fit = F.least("n_words", "na") >= similarity * F.greatest("n_words", "na")
    each = met.filter(fit).groupBy(F.col("node").alias("b"), "a").agg(
        F.count(F.lit(1)).alias("_c"), F.first(F.col("na").cast("long")).alias("na"), F.first(F.col("n_words").cast("long")).alias("nb"))
    best = F.max(F.struct("_c", F.xxhash64("a", F.lit(turn)).alias("_h"), "a", "na", "nb")).alias("_best")
    return each.groupBy("b").agg(best).select("_best.a", "_best.na", "b", "_best.nb")


def linked_classes(links: DataFrame) -> DataFrame:
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    found = connected_components(ends, links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    return written(found.select(F.col("id").alias("_id"), "component"), "classes")


def classed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``members`` with the class of their node: the component it is linked into, else the node."""
    return members.select("bucket", "node", "n_words").join(classes.hint("merge"), F.col("node") == F.col("_id"), "left").select(
        "bucket", "node", "n_words", F.coalesce("component", "node").alias("cls"))


def linked_nodes(texts: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES, picks: int = PICKS, most: int = GROUP) -> DataFrame | None:
    """``<_id, component>`` of the nodes of ``texts`` ``<node, text>`` that are linked to others, None if there are none."""
    # a bucket's rows are looked at one after the other; those without a neighbour leave
    order = Window.partitionBy("bucket").orderBy("node")
    every = buckets(texts, similarity, sketches, picks)
    near = every.select("*", F.lag("node").over(order).alias("_p"), F.lead("node").over(order).alias("_q"))
    members = written(near.filter("_p is not null or _q is not null").select("bucket", "node", "n_words"), "buckets")
    # every pair is one of members: texts without a neighbour in any bucket move here for the last time
    used = written(texts.join(members.select("node").distinct().hint("merge"), "node", "left_semi"), "used")
    bag_of = written(bags(used), "bags")
    known = members.withColumn("cls", F.col("node"))
    links = classes = None
    turn = 0
    while True:
        pairs = written(led_pairs(known, similarity, turn), "pairs")
        found = written(verify(plausible(pairs, bag_of, similarity), used, similarity), "links")
        n_pairs, n_found, turn = pairs.count(), found.count(), turn + 1
        if n_found:
            links = found if links is None else links.unionByName(found)
            classes = linked_classes(links)
            known = classed(members, classes)
        if n_found < YIELD * n_pairs or not n_found:
            break
    found = written(remaining_links(known, used, bag_of, similarity, most), "links")
    if not found.isEmpty():
        classes = linked_classes(found if links is None else links.unionByName(found))
    return classes


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                    sketches: int = SKETCHES, picks: int = PICKS) -> DataFrame:
    """``<id, class_id, node>``, one row per input row.

    ``class_id`` is the smallest id of the class, ``node`` a 64-bit hash of the text.  Equal texts are one node; null counts
    as the empty text, and texts without words are near duplicates of equal texts only.  Rows with null ids belong to
    classes but name them only if no other row does (class_id null).  Other columns are not read; repeated rows
    stay.  An empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "node", text_node(F.col("text")))
    # copies combine before they move
    texts = written(base.groupBy("node").agg(F.first("text").alias("text"), F.min("id").alias("id")), "texts")
    classes = linked_nodes(texts.select("node", "text"), similarity, sketches, picks)
    nodes = texts.select("node", "id")
    if classes is None:
        named = nodes.select(F.col("node").alias("_n"), F.col("id").alias("class_id"))
    else:
        inside = written(nodes.join(classes.hint("merge"), F.col("node") == F.col("_id")).select("node", "id", "component"), "linked")
        name = inside.groupBy("component").agg(F.min("id").alias("class_id")).select(F.col("component").alias("_c"), "class_id")
        inside = lookup_join(inside, name, "component", "_c").select(F.col("node").alias("_n"), "class_id")
        alone = nodes.join(classes.hint("merge"), F.col("node") == F.col("_id"), "left_anti").select(F.col("node").alias("_n"), F.col("id").alias("class_id"))
        named = inside.unionByName(alone)
    found = lookup_join(base.select("id", "node"), written(named, "named"), "node", "_n")
    return found.select(F.col("id").alias(id_col), "class_id", "node")


def text_node(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(1))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: the one of smallest id (nulls last), then smallest text hash; of repeated rows one.

    All columns stay, whatever their names.  Null text counts as empty; an empty table gives no rows.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    rank = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "node")
    first = found.groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("node")).alias("_own")).agg(F.min(rank).alias("first"))
    kept = first.select(F.col("first.id").alias("_id"), F.col("first.node").alias("_node")).distinct()
    mark = "_n"
    while mark in docs.columns:
        mark += "_"
    tagged = docs.withColumn(mark, text_node(F.col(text_col)))
    out = tagged.join(kept, tagged[mark].eqNullSafe(kept["_node"]) & tagged[id_col].eqNullSafe(kept["_id"]), "left_semi")
    return out.dropDuplicates([id_col, mark]).drop(mark)
