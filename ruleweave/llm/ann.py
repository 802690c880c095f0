"""Nearest neighbours by a hash-prefix forest.

Every tree hashes a vector to a string of 32 bits, one random hyperplane each,
shifted to pass through the mean of the block's vectors.  A tree is the sorted array
of those strings.  A query descends every tree to the longest prefix that it shares
with an entry; then all trees ascend together, one bit at a time, until the entries
under the shared prefixes reach the wanted number of candidates, whose exact
distances decide.

Vectors are dealt into blocks of bounded size by a hash of their id, each with a
forest of its own, built in memory from the block's rows alone; queries stream through
every block, and the best of each block are merged.  A block's candidates are a share
of its rows, so recall does not depend on how many blocks there are, equal vectors do
not meet in one task, and merging is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.llm.common import share_code

TREES = 16
BITS = 32
#: Entries that a query wants under its shared prefixes, all trees together: this many per row of the block, and
#: this many at least.  (An entry of several trees counts in each; it is one candidate.)
SHARE = 1.25
LEAST = 400
BLOCK_ROWS = 32_768
QUERY_SLICE = 64
#: Where there are fewer blocks than cores, a block's queries are dealt over several tasks, of this many queries at least.
TASK_QUERIES = 256


class Forest:
    """Sorted hash strings of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES, seed: int = 11):
        order = np.lexsort((*vectors.T[::-1], ids))  # equal rows count once
        ids, vectors = ids[order], vectors[order]
        keep = np.ones(len(ids), bool)
        keep[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(1)
        self.ids, self.vectors, self.trees = ids[keep], vectors[keep], trees
        self.repeats = bool((self.ids[1:] == self.ids[:-1]).any())
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((vectors.shape[1], trees * BITS))
        self.centre = self.vectors.mean(0)
        hashes = self.hashes(self.vectors)
        self.order = np.argsort(hashes, axis=0, kind="stable")
        self.sorted = np.take_along_axis(hashes, self.order, 0)

    def hashes(self, vectors: np.ndarray) -> np.ndarray:
        bits = ((vectors - self.centre) @ self.planes > 0).reshape(len(vectors), self.trees, BITS)
        return bits.astype(np.uint64) @ (np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64))

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end, in every tree's array, of the entries that share each prefix length: ``[query, tree, length]``."""
        h = self.hashes(queries)
        free = (np.uint64(1) << np.arange(BITS, -1, -1, dtype=np.uint64)) - np.uint64(1)
        low, high = h[:, :, None] & ~free, h[:, :, None] | free
        begin, end = np.empty(low.shape, np.int64), np.empty(low.shape, np.int64)
        for t in range(self.trees):
            begin[:, t] = np.searchsorted(self.sorted[:, t], low[:, t])
            end[:, t] = np.searchsorted(self.sorted[:, t], high[:, t], side="right")
        return begin, end

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float, least: int):
        """Yields (query, ids, distances) of the k nearest candidates, nearest first."""
        want = max(least, int(np.ceil(share * len(self.ids))))
        begin, end = self.ranges(queries)
        held = (end - begin).sum(1)  # [query, length], falls with the length
        for q in range(len(queries)):
            enough = np.flatnonzero(held[q] >= want)
            level = enough[-1] if len(enough) else 0
            mark = np.zeros(len(self.ids), bool)
            for t in range(self.trees):
                mark[self.order[begin[q, t, level]:end[q, t, level], t]] = True
            mark &= self.ids != query_ids[q]
            at = np.flatnonzero(mark)
            gap = self.vectors[at] - queries[q]
            far = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            if self.repeats:  # the nearest vector of each id
                order = np.lexsort((far, self.ids[at]))
                at, far = at[order], far[order]
                first = np.ones(len(at), bool)
                first[1:] = self.ids[at[1:]] != self.ids[at[:-1]]
                at, far = at[first], far[first]
            if len(at) > k:  # all within the k-th distance, so that ties go by id
                at, far = at[near := far <= np.partition(far, k - 1)[k - 1]], far[near]
            best = np.lexsort((self.ids[at], far))[:k]
            yield q, self.ids[at[best]], far[best]


def usable(vector: str = "embedding") -> "F.Column":
    """Vectors that take part: not null, all components finite, not all zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def search(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           share: float = SHARE, least: int = LEAST, block_rows: int = BLOCK_ROWS, trees: int = TREES) -> DataFrame:
    """``<query_id, rank, vec_id, score>``: the ``k`` nearest rows found for each query, own id left out.

    Only vectors of the query's length compare.  Rows with a null id and unusable
    vectors take no part; every vector of a repeated id is a candidate and the nearest counts; of queries with
    the same id the one with the smallest vector does.  Ties go to the smaller id; a query with fewer candidates has fewer
    rows, and an empty table gives none.  Other columns are not read.  A task holds one
    block (``block_rows`` on average) and streams queries past it.  While there are fewer blocks than cores, a block goes to
    several tasks, each with a share of the queries; they build the same forest, so the result is the same.
    """
    share_code(rows.sparkSession)
    take = lambda df: df.filter(usable(vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    base = take(rows)
    blocks = max(1, -(-base.count() // block_rows))
    asked = take(queries).groupBy("id").agg(F.min("v").alias("v"))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    copies = max(1, min(-(-take(queries).count() // TASK_QUERIES), -(-cores // blocks)))
    block = F.pmod(F.xxhash64("id", "v"), F.lit(blocks))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    side = base.withColumn("copy", each(copies)).select(
        (block * copies + F.col("copy")).cast("int").alias("task"), F.size("v").alias("dim"), F.lit(0).alias("kind"), "id", "v")
    into = asked.withColumn("block", each(blocks)).select(
        (F.col("block") * copies + F.pmod(F.xxhash64("id"), F.lit(copies))).cast("int").alias("task"),
        F.size("v").alias("dim"), F.lit(1).alias("kind"), "id", "v")
    dealt = (side.unionByName(into).repartitionById(blocks * copies, F.col("task"))
             .sortWithinPartitions("task", "dim", "kind"))
    schema = "query_id bigint, vec_id bigint, score double"
    arrow = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        """Rows come task by task, those to be searched before the queries."""
        at, ids, vectors, forest = None, [], [], None
        for batch in batches:
            keys = list(zip(batch["task"].to_pylist(), batch["dim"].to_pylist(), batch["kind"].to_pylist()))
            begin = 0
            while begin < len(keys):
                end = begin
                limit = begin + (QUERY_SLICE if keys[begin][2] else len(keys))
                while end < len(keys) and end < limit and keys[end] == keys[begin]:
                    end += 1
                task, dim, kind = keys[begin]
                mine = batch["id"].slice(begin, end - begin).to_numpy()
                part = batch["v"].slice(begin, end - begin).flatten().to_numpy().reshape(-1, dim)
                if (task, dim) != at:
                    at, ids, vectors, forest = (task, dim), [], [], None
                if kind == 0:
                    ids.append(mine)
                    vectors.append(part)
                elif ids:
                    if forest is None:
                        forest = Forest(np.concatenate(ids), np.vstack(vectors), trees)
                        ids, vectors = [None], []
                    found = list(forest.search(mine, part, k, share, least))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([np.full(len(i), mine[q]) for q, i, _ in found])),
                        pa.array(np.concatenate([i for _, i, _ in found])),
                        pa.array(np.concatenate([d for _, _, d in found]))], schema=arrow)
                begin = end

    # vectors of an id may lie in several blocks
    found = dealt.mapInArrow(run, schema).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
