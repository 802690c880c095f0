"""Prefix trie of conversations by union-find over neighbours of the sorted order.

A conversation is the sequence of its turns; a turn is the 128-bit hash of role and text (16 bytes), so texts never
move.  Conversations are range-sorted by their sequence, every neighbour pair gives an edge as deep as their longest
common prefix (LCP), and edges are taken in descending depth: union-find joins the components at both ends, and the
merge is a branching node of that depth (:func:`forest`).  Turns between two branching nodes are unary nodes.

The order is cut into blocks.  Each block makes its own forest.  A node that reaches over a block's border (its depth is at most
the LCP across the border) is open: every block that holds some of its members gives a partial row, and partial
rows of one prefix are summed.  All sums are additive because each block knows the LCPs at its borders: a node or
childless end is counted by one block only.  All other nodes are final within their block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.llm.common import map_slices, share_code, written
from ruleweave.operators.skew import lookup_join

#: Bytes of a turn's key.
KEY = 16
#: A conversation takes over at most so many turns of the first one of its hundred, less one.
HEADS = 6
GROUP = 100
#: Turns (each conversation counting one more) of a block.
BLOCK_TURNS = 1 << 15
EMPTY = hashlib.sha256(b"").hexdigest()

SORTED = ("pid int, blk int, pos long, last boolean, conv_id long, seq binary, chars array<int>, before int, after int")
PARTS = ("open boolean, key binary, parent_key binary, pid int, blk int, conv_id long, depth long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string")


# ---- sequences -------------------------------------------------------------------------------------------------

def turn_key(role: Column, text: Column) -> Column:
    """Hash of a turn as 32 hex digits; the role's length keeps role and text apart."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def own_turns(conversations: DataFrame) -> DataFrame:
    """``<conv_id, own>``: light turns ``<turn, role, k, n>`` in order (turn, nulls first; ties by role, then hash)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), turn_key(role, text).alias("k"), F.length(text).alias("n"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "k", "n"))).alias("own"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``<conv_id, seq, chars>``: each conversation with the first h turns of the first one of its hundred before its own turns after the first h.

    ``seq`` joins the turns' hashes, ``chars`` holds their code points.
    """
    own = own_turns(conversations)
    base = own.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("_base"), F.slice("own", 1, HEADS - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    both = own.withColumn("_b", F.col("conv_id") - F.col("conv_id") % GROUP).join(base, F.col("_b") == F.col("_base"), "left")
    turns = F.concat(F.coalesce(F.slice("_head", F.lit(1), h), F.slice("own", 1, 0)), F.slice("own", h + 1, F.size("own")))
    return both.select("conv_id", F.explode(F.array(turns)).alias("_t")).select(
        "conv_id", F.unhex(F.array_join(F.transform("_t", lambda t: t["k"]), "")).alias("seq"),
        F.transform("_t", lambda t: t["n"]).alias("chars"))


def lcp(a: bytes, b: bytes) -> int:
    """Common leading turns."""
    lo, hi = 0, min(len(a), len(b)) // KEY
    if a[:hi * KEY] == b[:hi * KEY]:
        return hi
    while hi - lo > 1:  # a[:lo] is common, a[:hi] is not
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo * KEY:mid * KEY] == b[lo * KEY:mid * KEY] else (lo, mid)
    return lo


# ---- one block -------------------------------------------------------------------------------------------------

def forest(depths: list[int], lcps: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Union-find over the edges between neighbours, the deepest first.

    ``depths`` are the rows' lengths, ``lcps[i]`` the LCP of rows i-1 and i.  Returns the nodes' depths, their parents (-1
    at the top) and the node of each row's end.  Merges at one depth make one node.
    """
    n = len(depths)
    depth, up, same = list(depths), [-1] * n, list(range(n))
    comp, top = list(range(n)), list(range(n))

    def find(links: list[int], x: int) -> int:
        while links[x] != x:
            links[x] = links[links[x]]
            x = links[x]
        return x

    for i in sorted(range(1, n), key=lambda i: -lcps[i]):
        d = lcps[i]
        a, b = find(comp, i - 1), find(comp, i)
        ta, tb = top[a], top[b]
        if depth[ta] == d:
            node = ta
            if depth[tb] == d:
                same[tb] = ta
            else:
                up[tb] = ta
        elif depth[tb] == d:
            node = tb
            up[ta] = tb
        else:
            node = len(depth)
            depth.append(d)
            up.append(-1)
            same.append(node)
            up[ta] = up[tb] = node
        comp[b] = a
        top[a] = node
    ends = [find(same, i) for i in range(n)]
    return depth, [p if p < 0 else find(same, p) for p in up], ends


def prefix_keys(seq: bytes, most: int) -> list[bytes]:
    """Hashes of the prefixes of 0 to ``most`` turns."""
    m = hashlib.md5()
    out = [m.digest()]
    for d in range(most):
        m.update(seq[d * KEY:(d + 1) * KEY])
        out.append(m.copy().digest())
    return out


def block_nodes(pid: int, blk: int, convs: list[int], seqs: list[bytes], chars: list[list[int]], before: int, inner: list[int],
                after: int) -> list[list]:
    """Rows of ``PARTS`` for the nodes that the block's rows stand on.

    ``before`` and ``after`` are the LCPs across the borders (-1 at the ends of the whole order), ``inner[i]`` that of rows i-1 and i.
    """
    n = len(seqs)
    lens = [len(s) // KEY for s in seqs]
    depth, up, ends = forest(lens, inner)
    m = len(depth)
    count, leaves, saved, kids = [0] * m, [0] * m, [0] * m, [0] * m
    low, lo, hi = [None] * m, [n] * m, [-1] * m
    members: dict[int, list[int]] = {}
    for i, v in enumerate(ends):
        count[v] += 1
        low[v] = convs[i] if low[v] is None else min(low[v], convs[i])
        lo[v], hi[v] = min(lo[v], i), max(hi[v], i)
        # the last of equal rows is a leaf unless the next row goes on from it
        leaves[v] += (inner[i + 1] if i + 1 < n else after) < lens[i]
        members.setdefault(v, []).append(convs[i])
    left, right = prefix_keys(seqs[0], max(before, 0)), prefix_keys(seqs[-1], max(after, 0))
    waiting: dict[int, list[list]] = {}
    out = []
    for v in sorted((v for v in range(m) if v >= n or ends[v] == v), key=lambda v: -depth[v]):
        p = up[v]
        if v >= n and hi[v] < 0:
            continue
        stop = depth[p] if p >= 0 else -1
        first, last = lo[v] == 0, hi[v] == n - 1
        row_chars = chars[lo[v]]

        def border(e: int) -> bytes | None:
            return left[e] if first and e <= before else right[e] if last and e <= after else None

        s, k, key = saved[v], kids[v], border(depth[v])
        for row in waiting.pop(v, ()):  # children wait for their parent's smallest member
            row[2], row[7] = (key, None) if key is not None else (None, low[v])
        for e in range(depth[v], stop, -1):
            fresh = not (first and e <= before)
            if e:
                s += (count[v] - fresh) * row_chars[e - 1]
            own = members.get(v) if e == depth[v] else None
            names = ",".join(map(str, own)) if own else None
            sha = None if key is not None else EMPTY if not own else hashlib.sha256(names.encode()).hexdigest()
            above = border(e - 1) if e else None
            row = [key is not None, key, above, pid, blk, low[v], e, low[v] if e and above is None else None, count[v], k,
                   leaves[v], s, sha, names if key is not None else None]
            out.append(row)
            k, key = int(fresh), above
        if p >= 0:
            waiting.setdefault(p, []).append(row)
            count[p] += count[v]
            leaves[p] += leaves[v]
            saved[p] += s
            kids[p] += k
            low[p] = low[v] if low[p] is None else min(low[p], low[v])
            lo[p], hi[p] = min(lo[p], lo[v]), max(hi[p], hi[v])
    return out


# ---- passes ----------------------------------------------------------------------------------------------------

def _annotated(block_turns: int):
    """Rows of a sorted partition with their block, place and the LCPs with their neighbours (-1 at the partition's ends)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SORTED.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.int32()]
        pid, blk, weight, pos, held, rows = TaskContext.get().partitionId(), 0, 0, 0, None, []

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            rows.clear()
            return out

        for part in batches:
            for conv, seq, chars in zip(*(c.to_pylist() for c in part.columns)):
                common = -1
                if held is not None:
                    common = lcp(held[5], seq)
                    held[8] = common
                    rows.append(held)
                size = len(chars) + 1
                if weight and weight + size > block_turns:
                    blk, weight = blk + 1, 0
                weight += size
                held = [pid, blk, pos, False, conv, seq, chars, common, -1]
                pos += 1
                if len(rows) >= 2000:
                    yield batch()
        if held is not None:
            held[3] = True
            rows.append(held)
        if rows:
            yield batch()

    return run


def _with_borders(rows: DataFrame) -> DataFrame:
    """The LCPs between the last row of a range partition and the first one of the next (two rows a partition are looked at)."""
    order = Window.orderBy("pid", "pos")
    ends = rows.filter((F.col("pos") == 0) | F.col("last")).select(
        "pid", "pos", "last", "seq", F.lag("seq").over(order).alias("prior"), F.lead("seq").over(order).alias("next"))

    def make():
        one = lambda at, a, b: lcp(a, b) if at and b is not None else None
        return lambda pid, pos, last, seq, prior, nxt: [
            pid, pos, [one(p == 0, s, x) for p, s, x in zip(pos, seq, prior)], [one(z, s, x) for z, s, x in zip(last, seq, nxt)]]

    found = map_slices(ends, make, "_pid int, _pos long, _before int, _after int")
    found = F.broadcast(written(found, "borders"))  # two rows a range partition
    return rows.join(found, (F.col("pid") == F.col("_pid")) & (F.col("pos") == F.col("_pos")), "left").select(
        "pid", "blk", "pos", "conv_id", "seq", "chars", F.coalesce("_before", "before").alias("before"),
        F.coalesce("_after", "after").alias("after"))


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of the blocks of a partition, whose rows come together and in order."""
    names = [f.split()[0] for f in PARTS.split(", ")]
    kind = {"boolean": pa.bool_(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    types = [kind[f.split()[1]] for f in PARTS.split(", ")]
    at, held = None, []

    def made():
        pid, blk = at
        convs, seqs, chars, before, after = zip(*held)
        nodes = block_nodes(pid, blk, list(convs), list(seqs), list(chars), before[0], list(before), after[-1])
        for lo in range(0, len(nodes), 4000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes[lo:lo + 4000]), types)], names=names)

    for part in batches:
        for pid, blk, _, *row in zip(*(c.to_pylist() for c in part.columns)):
            if at != (pid, blk):
                if held:
                    yield from made()
                at, held = (pid, blk), []
            held.append(row)
    if held:
        yield from made()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined pieces of each key, one piece at a time."""
    def row():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([m.hexdigest()])], names=["_key", "_sha"])

    at, m = None, None
    for part in batches:
        for key, piece in zip(part.column(0).to_pylist(), part.column(3).to_pylist()):
            if key != at:
                if m is not None:
                    yield row()
                at, m = key, hashlib.sha256(piece.encode())
            else:
                m.update(b"," + piece.encode())
    if m is not None:
        yield row()


def prefix_trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (see :func:`rebuilt`), the empty one included.

    ``<conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256>``: smallest member, turns of
    the prefix, smallest member of the prefix one turn shorter, members, distinct prefixes one turn longer, childless
    nodes in the subtree, code points that sharing saves in the subtree, and the SHA-256 of the ascending ids of the members that end here.

    Null role or text counts as empty; a null turn comes first; turns of equal number are ordered by role, then text hash, and
    repeated rows are turns of their own.  Rows without conv_id belong to no conversation.  Other columns are not read.
    An empty table gives no rows.  Turns are known by a 128-bit hash of role and text.  Texts of any length count by their
    code points; a conversation is one row of 20 bytes a turn.  Equal conversations are split over blocks like others.
    """
    share_code(conversations.sparkSession)
    ranged = rebuilt(conversations).repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    rows = written(ranged.select("conv_id", "seq", "chars").mapInArrow(_annotated(block_turns), SORTED), "sorted")
    blocks = _with_borders(rows).repartition("pid", "blk").sortWithinPartitions("pid", "blk", "pos")
    parts = written(blocks.mapInArrow(_forests, PARTS), "forests")

    opened = parts.filter("open")
    # ids ascend from block to block, so the pieces of a prefix are hashed one after the other
    pieces = opened.filter("ends is not null").select("key", "pid", "blk", "ends")
    digests = pieces.repartition("key").sortWithinPartitions("key", "pid", "blk").mapInArrow(_digests, "_key binary, _sha string")
    merged = opened.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    merged = written(merged.join(digests, F.col("key") == F.col("_key"), "left").select(
        *merged.columns, F.coalesce("_sha", F.lit(EMPTY)).alias("ends_sha256")), "open")
    parents = merged.select(F.col("key").alias("_pk"), F.col("conv_id").alias("_pc"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = lookup_join(parts.filter("not open").select("parent_key", *columns), parents, "parent_key", "_pk", how="left")
    inner = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_pc")).select(*columns)
    outer = lookup_join(merged, parents, "parent_key", "_pk", how="left").withColumnRenamed("_pc", "parent_conv_id").select(*columns)
    return inner.unionByName(outer)
