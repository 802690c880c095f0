"""Sequence packing along a space-filling curve.

1. Every text is tokenised once; its tokens are counted into a hashed vector,
   which a fixed random projection takes to a few dimensions.  The Hilbert
   index of that point is the document's place on the curve.  Ids are written
   compressed to the shared folder, with key and count as light columns.
2. Only the light columns are range-sorted by (key, id); running sums inside
   each range plus the totals of the ranges before give every document its
   place in one endless token stream.
3. The stream is cut every ``length`` tokens, so neighbours on the curve share
   sequences and only the last sequence of the corpus is padded.
"""

from __future__ import annotations

import base64
import os
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.llm.common import map_slices, written

DIMENSIONS = 4
BITS = 12
HASHED = 1024
SEED = 20240229
#: Coordinates of unit vectors are cut at this many standard deviations.
SPREAD = 4.0
#: Texts with a character beyond this one are left to the slower library.
PLAIN = re.compile("[^\x00-ɏ]")


def projection(seed: int = SEED, hashed: int = HASHED, dims: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((hashed, dims))


def hashed_vector(ids: np.ndarray, hashed: int = HASHED) -> np.ndarray:
    """Unit vector of log counts of token ids hashed into ``hashed`` cells."""
    cells = (ids.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(hashed)
    v = np.log1p(np.bincount(cells.astype(np.int64), minlength=hashed))
    n = np.linalg.norm(v)
    return v / n if n else v


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points ``[n, d]`` in ``[0, 2**bits)`` (d * bits below 63)."""
    x = points.T.astype(np.int64).copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo rotations and reflections from the top bit down
        low = q - 1
        for i in range(d):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(hit, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[d - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_key(vectors: np.ndarray, plane: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of projected vectors."""
    top = (1 << bits) - 1
    cells = np.rint((vectors @ plane / SPREAD + 1) / 2 * top)
    return hilbert_index(np.clip(cells, 0, top).astype(np.int64), bits)


class Tokenizer:
    """Ids of ``byte_bpe`` texts.

    ``ranks`` names the same vocabulary as byte ranks; its encoder is several
    times faster and serves the texts on whose characters both libraries
    agree, the other texts go to the ``json`` one.
    """

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer as Library

        self.slow = Library.from_file(json_path)
        self.special = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items()}
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is None or PLAIN.search(text) or any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


_TOKENIZERS: dict[tuple, Tokenizer] = {}


def _tokenizer(*paths) -> Tokenizer:
    if paths not in _TOKENIZERS:
        _TOKENIZERS[paths] = Tokenizer(*paths)
    return _TOKENIZERS[paths]


def tokenized(docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None,
              end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id, curve, n, ids>``: place on the curve, token count with ``end_id``, ids (compressed 16 or 32-bit)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    paths = (json_path, ranks_path, pattern)

    def make():
        import zstandard

        tok, plane, pack = _tokenizer(*paths), projection(), zstandard.ZstdCompressor(level=1)

        def fn(keys, texts):
            n, blobs, vectors = [], [], []
            for t in texts:
                ids = np.array(tok.ids(t or "") + [end_id], dtype="<u4")
                vectors.append(hashed_vector(ids[:-1]))
                n.append(len(ids))
                blobs.append(pack.compress(ids.astype("<u2").tobytes()) if ids.max() < 65536
                             else b"W" + pack.compress(ids.tobytes()))
            return [keys, curve_key(np.array(vectors), plane).tolist(), n, blobs]

        return fn

    return map_slices(docs.select(F.col(id_col), F.col(text_col)), make,
                      f"`{id_col}` {id_type}, curve bigint, n bigint, ids binary")


def unpack_ids(blob: bytes) -> np.ndarray:
    """Ids as little-endian unsigned 32-bit integers."""
    import zstandard

    open_ = zstandard.ZstdDecompressor().decompress
    return np.frombuffer(open_(blob[1:]), "<u4") if blob[:1] == b"W" else np.frombuffer(open_(blob), "<u2").astype("<u4")


def stream_starts(light: DataFrame, size_col: str, order: list[str]) -> DataFrame:
    """``light`` with ``stream_start``: the sum of ``size_col`` over all rows before, in the given order.

    No global window: rows are range-partitioned by ``order`` and written with
    their range's number; sums run inside a range, and the totals of the ranges
    before (one row per range) are broadcast.
    """
    cols = light.columns
    ranged = written(light.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (ranged.groupBy("_range").agg(F.sum(size_col).alias("_sum"))
              .select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")))
    return (ranged.withColumn("_inside", F.coalesce(F.sum(size_col).over(inside), F.lit(0)))
            .join(F.broadcast(totals), "_range")
            .select(*cols, (F.col("_before") + F.col("_inside")).alias("stream_start")))


def pack(docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None,
         length: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = False) -> DataFrame:
    """Pieces ``<id, start, length, ids_crc32, doc_tokens, sequence_id, offset, curve>`` (and ``ids``) of every document.

    Every id of a document (text, then ``end_id``) lies in exactly one piece;
    sequences are full but for the corpus's last one.  A null or empty text is
    one ``end_id``; rows with equal or null ids are separate documents; equal curve places are
    ordered by id, then by an arbitrary row number.  Other columns are not read.  An
    empty table gives no pieces.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    tokens = tokenized(docs, json_path, ranks_path, pattern, end_id, id_col, text_col)
    tokens = written(tokens.toDF("key", "curve", "n", "ids").withColumn("row", F.monotonically_increasing_id()), "tokens")
    starts = stream_starts(tokens.select("row", "key", "curve", "n"), "n", ["curve", "key", "row"])
    placed = tokens.select("row", "key", "curve", "ids").join(
        starts.select("row", "stream_start").hint("shuffle_hash"), "row")

    def make():
        def fn(keys, curves, blobs, begins):
            out: list[list] = [[] for _ in range(8 + with_ids)]
            for key, curve, blob, begin in zip(keys, curves, blobs, begins):
                ids, at = unpack_ids(blob), 0
                while at < len(ids):
                    seq, off = divmod(begin + at, length)
                    part = ids[at:at + length - off]
                    row = [key, at, len(part), zlib.crc32(part.tobytes()), len(ids), seq, off, curve]
                    for col, v in zip(out, [*row, part.tolist()]):
                        col.append(v)
                    at += len(part)
            return out

        return fn

    return map_slices(placed.select("key", "curve", "ids", "stream_start"), make,
                      f"`{id_col}` {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                      "sequence_id bigint, offset bigint, curve bigint" + ", ids array<int>" * with_ids)
