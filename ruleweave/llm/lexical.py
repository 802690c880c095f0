"""Ranked lexical search with range maxima: best-first search over intervals of documents.

The score is BM25-like in 64-bit integers (:func:`search`).  A document holds for every query term the impact of its
frequency and length.  Documents are dealt into shards of about ``SHARD_POSTINGS`` postings.  In a shard documents stand in
descending order of length, so neighbours have like impacts, and every posting list carries a sparse table of range maxima.  A
query starts with the interval of all documents.  The bound of an interval is the sum over the query's terms of weight times
the largest impact in it, read from the tables in constant time.  The interval of the largest bound is split at the document that
holds the largest single contribution, whose score is computed; short intervals are scored at once.  An interval leaves as soon
as its bound can't reach the best ``k`` any more, so results are exact.

Two runs over the shards: the first stops each query after a few splits, and the k-th best score over all shards is then a lower
bound that the second, complete one starts from.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.llm.common import share_code, slices, written

TOP = 20
#: Postings of a shard, about.
SHARD_POSTINGS = 1 << 20
#: Items and bytes of their texts that are searched for together.
BLOCK_ITEMS = 10_000
BLOCK_BYTES = 32 << 20
#: Documents of an interval that is scored at once, and intervals that a query takes in the first run.
SHORT = 256
FIRST_RUN = 8
# Fixed values of the score.
SCALE = 1_000_000_000
FREE, SHARE = 75, 25

#: Bytes of terms in lower case, all others blank; bytes of code points above 127 belong to terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

POSTINGS = "row long, doc_id long, n long, terms array<int>, tfs array<int>"
NO_ID = np.iinfo(np.int64).max


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# ---- one shard -------------------------------------------------------------------------------------------------

class Shard:
    """Posting lists of a shard with sparse tables of range maxima.

    ``doc`` and ``impact`` hold all lists one after the other, by term and then by document; ``best[j]`` holds for each
    posting the place of the largest impact among it and the ``2^j - 1`` after it.
    """

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_docs: int, total: int):
        order = np.lexsort((ids, -lengths))
        self.ids, self.size = ids[order], len(ids)
        m = FREE + (SHARE * lengths[order] * n_docs) // max(total, 1)
        place = np.empty(self.size, np.int64)
        place[order] = np.arange(self.size)
        doc = np.repeat(place, counts)
        self.keys = terms.astype(np.int64) * self.size + doc
        by = np.argsort(self.keys, kind="stable")
        self.keys, tf = self.keys[by], tfs[by].astype(np.int64)
        self.doc = self.keys % max(self.size, 1)
        self.impact = (SCALE * tf) // (1000 * tf + 12 * m[self.doc])
        longest = int(np.bincount(terms).max()) if len(terms) else 1
        self.best = [np.arange(len(self.keys), dtype=np.int32)]
        for j in range(1, longest.bit_length()):
            last, step = self.best[-1], 1 << (j - 1)
            right = last[np.minimum(np.arange(len(last)) + step, len(last) - 1)]
            self.best.append(np.where(self.impact[right] > self.impact[last], right, last))
        self.table = np.concatenate(self.best)
        self.level = np.zeros(longest + 1, np.int64)  # of the largest power of two within a length
        self.level[1:] = np.frexp(np.arange(1, longest + 1, dtype=np.float64))[1] - 1
        self.power = np.int64(1) << np.arange(self.level[-1] + 1)
        self.first_id = [self.ids]  # range minima of ids break ties between equal bounds
        while (1 << len(self.first_id)) <= self.size:
            last, step = self.first_id[-1], 1 << (len(self.first_id) - 1)
            self.first_id.append(np.minimum(last, last[np.minimum(np.arange(self.size) + step, self.size - 1)]))

    def least_id(self, a: int, b: int) -> int:
        j = (b - a).bit_length() - 1
        return int(min(self.first_id[j][a], self.first_id[j][b - (1 << j)]))

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Places of the largest impacts among the postings lo..hi-1 of each pair, none of them empty."""
        j = self.level.take(hi - lo)
        row = j * len(self.keys)
        left, right = self.table.take(row + lo), self.table.take(row + hi - self.power.take(j))
        return np.where(self.impact.take(right) > self.impact.take(left), right, left)

    def scores(self, a: int, b: int, lo: np.ndarray, hi: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of the documents a..b-1 from their postings."""
        sizes = hi - lo
        ends = sizes.cumsum()
        at = np.repeat(lo - ends + sizes, sizes) + np.arange(int(ends[-1]))
        parts = self.impact.take(at) * np.repeat(weights, sizes)
        out = np.zeros(b - a, np.int64)
        np.add.at(out, self.doc.take(at) - a, parts)
        return out

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: tuple[int, int], splits: int | None) -> list[tuple[int, int]]:
        """The best ``(score, id)`` of the shard, ``k`` at most, that reach ``floor`` (a score and, at that score, an id not larger).

        With ``splits`` it stops after so many intervals: what it has found is exact but may not be all.
        """
        base = terms.astype(np.int64) * self.size
        lo, hi = np.searchsorted(self.keys, base), np.searchsorted(self.keys, base + self.size)
        top: list[tuple[int, int]] = []  # a heap: the worst one first, (score, -id)
        limit = (floor[0], -floor[1])
        heap: list[tuple] = []

        def add(score: int, id_: int) -> None:
            nonlocal limit
            if score <= 0 or (score, -id_) < limit:
                return
            heapq.heappush(top, (score, -id_))
            if len(top) > k:
                heapq.heappop(top)
            if len(top) == k:
                limit = max(limit, top[0])

        def push(a: int, b: int, base, lo, hi, weights) -> None:
            """The interval of documents a..b-1, with the terms that it holds, unless its bound rules it out."""
            held = (hi > lo).nonzero()[0]
            if b <= a or not len(held):
                return
            if len(held) < len(lo):
                base, lo, hi, weights = base.take(held), lo.take(held), hi.take(held), weights.take(held)
            at = self.maxima(lo, hi)
            parts = self.impact.take(at) * weights
            bound = int(parts.sum())
            if bound >= limit[0]:
                least = self.least_id(a, b)
                if (bound, -least) >= limit:
                    heapq.heappush(heap, (-bound, least, a, b, base, lo, hi, weights, int(at[parts.argmax()])))

        if self.size:
            push(0, self.size, base, lo, hi, weights)
        taken = 0
        while heap and (splits is None or taken < splits):
            bound, least, a, b, base, lo, hi, weights, split = heapq.heappop(heap)
            if (-bound, -least) < limit:
                break  # no interval left can hold a better one
            taken += 1
            if b - a <= SHORT:
                scores = self.scores(a, b, lo, hi, weights)
                for i in np.flatnonzero(scores >= max(limit[0], 1)).tolist():
                    add(int(scores[i]), int(self.ids[a + i]))
                continue
            x = int(self.doc[split])
            mid = np.searchsorted(self.keys, base + x)
            here = self.doc.take(mid, mode="clip") == x
            here &= mid < hi
            add(int((self.impact.take(mid, mode="clip") * weights)[here].sum()), int(self.ids[x]))
            push(a, x, base, lo, mid, weights)
            push(x + 1, b, base, mid + here, hi, weights)
        return [(s, -i) for s, i in top]


# ---- passes ----------------------------------------------------------------------------------------------------

def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Per document with a term: a row number, id, length and the query terms it holds with their frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = shared.value, TaskContext.get().partitionId() << 33
        for part in slices(batches):
            out = []
            for id_, text in zip(*(c.to_pylist() for c in part.columns)):
                found = Counter(terms_of(text or ""))
                if found:
                    held = [(known[t], c) for t, c in found.items() if t in known]
                    out.append((row, id_, found.total(), [t for t, _ in held], [c for _, c in held]))
                    row += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                    names=["row", "doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, POSTINGS)


def _searched(dealt: DataFrame, queries, n_docs: int, total: int, k: int, floors, splits: int | None) -> DataFrame:
    """``<item, doc_id, score>``: the best of every shard (a partition) for each of the broadcast queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        flat = [t.column(c).combine_chunks() for c in ("terms", "tfs")]
        shard = Shard(t.column("doc_id").fill_null(int(NO_ID)).to_numpy(), t.column("n").to_numpy(),
                      np.diff(flat[0].offsets.to_numpy()), flat[0].flatten().to_numpy(), flat[1].flatten().to_numpy(), n_docs, total)
        out = []
        for item, (terms, weights) in enumerate(queries.value):
            floor = floors.value[item] if floors is not None else (0, int(NO_ID))
            out += [(item, None if id_ == NO_ID else id_, score) for score, id_ in shard.search(terms, weights, k, floor, splits)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["item", "doc_id", "score"])

    return dealt.mapInArrow(run, "item long, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block(spark, docs: DataFrame, texts: list[str], id_col: str, text_col: str, k: int, shard_postings: int) -> DataFrame | None:
    """``<item, doc_id, score, rank>`` for a block of query texts."""
    sc = spark.sparkContext
    wanted = [Counter(terms_of(t)) for t in texts]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*wanted)))} if wanted else {}
    if not vocabulary:
        return None
    held = written(postings(docs, vocabulary, id_col, text_col), "postings")
    n_docs, total = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    # at most one row per query term of the block
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in held.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[term] = n
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    queries = sc.broadcast([(np.array([vocabulary[t] for t in w], np.int64),
                             np.array([weights[vocabulary[t]] * c for t, c in w.items()], np.int64)) for w in wanted])
    shards = max(1, math.ceil(int(df.sum()) / shard_postings), math.ceil(n_docs / shard_postings))
    held = held.filter(F.size("terms") > 0).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    dealt = held.repartitionById(shards, "shard").select("doc_id", "n", "terms", "tfs")
    first = _best(_searched(dealt, queries, n_docs, total, k, None, FIRST_RUN), k)
    floors = [(0, int(NO_ID))] * len(texts)
    for item, doc_id, score in first.filter(F.col("rank") == k).select("item", "doc_id", "score").toLocalIterator():
        floors[item] = (score, int(NO_ID) if doc_id is None else doc_id)
    return _best(_searched(dealt, queries, n_docs, total, k, sc.broadcast(floors), None), k)


def search(items: DataFrame, docs: DataFrame, k: int = TOP, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text",
           shard_postings: int = SHARD_POSTINGS, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``<item, rank, id, score>``: the ``k`` best documents with a score above 0 of each row of ``items``.

    Terms are runs of ASCII letters, ASCII digits and code points above 127, with A-Z in lower case.  With N documents that
    hold a term, L their terms and df the documents that hold a term, its weight is ``floor(1000 ln((2N + 2) / (2df + 1)))``; a document of n
    terms has ``m = 75 + (25 n N) div L``, and its score is the sum over the item's terms, repeats included, of the weight times
    ``(10^9 tf) div (1000 tf + 12 m)``.  Equal scores rank by ascending id, null ids last.

    Null and empty texts hold no term: such items find nothing, such documents count for nothing.  Repeated rows of either
    table are items or documents of their own.  Other columns are not read.  An empty table gives no rows.  Items are searched for in
    blocks of at most ``block_items`` rows and about ``block_bytes`` bytes; one block's texts and document frequencies are on the driver at a time.
    """
    spark = docs.sparkSession
    share_code(spark)
    rows = written(items.select(F.col(item_col).alias(item_col), F.coalesce(F.col("text"), F.lit("")).alias("text"))
                   .withColumn("_row", F.monotonically_increasing_id()), "items")
    n_items, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(n_items / block_items), math.ceil(size / block_bytes))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    out = None
    for block in range(blocks):
        texts = [(r["_row"], r["text"]) for r in rows.filter(F.col("_block") == block).select("_row", "text").toLocalIterator()]
        found = _block(spark, docs, [t for _, t in texts], id_col, text_col, k, shard_postings)
        if found is None:
            continue
        numbers = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(texts)], "item long, _row long")
        found = found.join(F.broadcast(numbers), "item").join(rows.select("_row", item_col), "_row").select(
            item_col, F.col("rank").cast("int").alias("rank"), F.col("doc_id").alias(id_col), "score")
        found = written(found, "ranked") if blocks > 1 else found
        out = found if out is None else out.unionByName(found)
    if out is not None:
        return out
    return rows.limit(0).select(item_col, F.lit(0).alias("rank"), F.lit(0).cast("long").alias(id_col), F.lit(0).cast("long").alias("score"))
