"""N-best SentencePiece segmentation and decoding.

The lattice of a text has one edge per vocabulary piece that matches at a
position, and one edge per character without a piece (its UTF-8 byte pieces,
scored as the smallest piece score less 10).  A forward Viterbi pass gives the
best score from the start to every position; because that is the exact cost
still to come, a backward A* search from the end pops complete paths in score
order.  No piece holds a word mark after another character, so the lattice of
a text is a chain of independent region lattices.  Every distinct region gets
the forward pass, which also tells what its second best loses; only the N-1
regions of a text that lose least can differ from the best in its N best, so
only those are searched, and their results are combined best first.
"""

from __future__ import annotations

import heapq
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ruleweave.llm.common import map_slices, share_code
from ruleweave.llm.token_counts import MARK, Proof, _library, normal_pieces, prove

UNKNOWN_PENALTY = 10.0
CACHE_REGIONS = 300_000
#: Strings up to these lengths are searched in lockstep.
LOCKSTEP = (6, 9, 14)
KEY = np.uint64(0x9E3779B97F4A7C15)
#: Slots of a lookup table, as a power of two.
PLACE_BITS = 16


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points of the words as columns, padded with 0."""
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width).T.astype(np.uint64) + np.uint64(1)


def _keys(codes: np.ndarray) -> np.ndarray:
    key = np.zeros(codes.shape[1], np.uint64)
    for c in codes:
        key = key * KEY + c
    return key


def _slot(key: np.ndarray, turn: int) -> np.ndarray:
    return key * np.uint64(0xBF58476D1CE4E5B9 + 0x1003F * 2 * turn) >> np.uint64(64 - PLACE_BITS)


def _places(key: np.ndarray) -> list[np.ndarray]:
    """Tables from a key's slot to its index (the last index stands for none); keys whose slots meet go to a further table."""
    out, left = [], np.arange(len(key))
    while len(left):
        slot = _slot(key[left], len(out))
        _, first = np.unique(slot, return_index=True)
        place = np.full(1 << PLACE_BITS, len(key), np.int32)
        place[slot[first]] = left[first]
        out.append(place)
        left = np.delete(left, first)
    return out


class Lattice:
    """Pieces and scores of one model, and the n best segmentations of one region."""

    def __init__(self, proof: Proof):
        self.sp = sp = _library(proof.path)
        pieces = normal_pieces(sp)
        self.ids = pieces
        self.score = {p: float(sp.get_score(i)) for p, i in pieces.items()}
        self.longest = max(map(len, pieces))
        self.unknown = min(self.score.values()) - UNKNOWN_PENALTY
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.starts = {p[:k] for p in pieces for k in range(1, len(p) + 1)}
        #: by piece length: where a 64-bit key may stand, the keys of the pieces, their scores and ids, for many lookups at once
        self.tables = []
        for n in range(1, self.longest + 1):
            mine = [p for p in pieces if len(p) == n] or [chr(0) * n]
            key = _keys(_codes(mine, n))
            if len(np.unique(key)) < len(key):
                raise ValueError("two pieces share a key")
            self.tables.append((_places(key), np.append(key, np.uint64(0)),
                                np.array([self.score.get(p, -np.inf) for p in mine] + [-np.inf]),
                                np.array([pieces.get(p, -1) for p in mine] + [-1])))

    def forward(self, s: str) -> tuple[list[float], list[list[tuple[int, float]]]]:
        """Best score from the start to every position, and the edges into it as (start, score)."""
        score, starts, n = self.score.get, self.starts, len(s)
        best = [0.0] + [float("-inf")] * n
        into: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            here, j = best[i], i + 1
            w = score(p := s[i])
            if w is None:
                w = self.unknown
            while True:
                if w is not None:
                    into[j].append((i, w))
                    if here + w > best[j]:
                        best[j] = here + w
                j += 1
                if j > n or p not in starts:
                    break
                w = score(p := s[i:j])
        return best, into

    def first(self, s: str) -> tuple[float, float, list[str]]:
        """Score and pieces of the best segmentation, and what the second best loses (infinity if there is none).

        The second best leaves the best path, seen from the end, by one edge and is best from there on, so its loss is the
        least among the other edges into positions of the best path: the first entries of the search's queue.
        """
        score, starts, n = self.score.get, self.starts, len(s)
        low = float("-inf")
        best, second, came = [0.0] + [low] * n, [low] * (n + 1), [0] * (n + 1)
        for i in range(n):
            here, j, p = best[i], i + 1, s[i]
            w = score(p)
            if w is None:
                w = self.unknown
            while True:
                if w is not None:
                    w += here
                    if w > best[j]:
                        second[j] = best[j]
                        best[j] = w
                        came[j] = i
                    elif w > second[j]:
                        second[j] = w
                if j == n or p not in starts:
                    break
                j += 1
                w = score(p := s[i:j])
        at, loss, pieces = n, float("inf"), []
        while at:
            if best[at] - second[at] < loss:
                loss = best[at] - second[at]
            i = came[at]
            pieces.append(s[i:at])
            at = i
        pieces.reverse()
        return best[n], loss, pieces

    def first_many(self, words: list[str]) -> tuple[list[float], list[float], list[bytes]]:
        """Scores, second losses and best ids (bytes) of many strings: :meth:`first` in lockstep over strings of about one length.

        Substrings are looked up by 64-bit key.  Longer strings, and those whose best path has a character without a piece, go through
        :meth:`first`.
        """
        scores, losses, parts = [0.0] * len(words), [0.0] * len(words), [b""] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        alone, floor = np.flatnonzero(size > LOCKSTEP[-1]).tolist(), 0
        for width in LOCKSTEP:
            at = np.flatnonzero((size > floor) & (size <= width))
            floor = width
            if len(at):
                top, loss, flat, ends, odd = self._lockstep([words[i] for i in at], size[at], width)
                raw, begin = flat.astype("<u4").tobytes(), 0
                for i, a, b, e, o in zip(at.tolist(), top.tolist(), loss.tolist(), (4 * ends).tolist(), odd.tolist()):
                    scores[i], losses[i], parts[i], begin = a, b, raw[begin:e], e
                    if o:
                        alone.append(i)
        for i in alone:
            scores[i], losses[i], pieces = self.first(words[i])
            parts[i] = array("I", self.to_ids(pieces)).tobytes()
        return scores, losses, parts

    def _lockstep(self, words: list[str], size: np.ndarray, width: int):
        codes, rows = _codes(words, width), len(words)
        best = np.full((width + 1, rows), -np.inf)
        best[0] = 0
        second, came = np.full((width + 1, rows), -np.inf), np.zeros((width + 1, rows), np.int64)
        which = np.full((width + 1, rows), -1)
        weight, ids, key = [], [], np.zeros((width, rows), np.uint64)
        for n in range(1, min(width, self.longest) + 1):
            key = key[:width - n + 1] * KEY + codes[n - 1:]
            places, known, score, piece = self.tables[n - 1]
            at = np.full(key.shape, len(known) - 1, np.int32)
            for turn, place in enumerate(places):
                hit = place[_slot(key, turn)]
                np.copyto(at, hit, where=known[hit] == key)
            weight.append(score[at] if n > 1 else np.where(at < len(known) - 1, score[at], self.unknown))
            ids.append(piece[at])
        for j in range(1, width + 1):
            for n in range(min(j, len(weight)), 0, -1):  # of equal scores the longest last piece, as in `first`
                v = best[j - n] + weight[n - 1][j - n]
                better = v > best[j]
                second[j] = np.where(better, best[j], np.maximum(second[j], v))
                best[j] = np.where(better, v, best[j])
                came[j][better] = n
                which[j] = np.where(better, ids[n - 1][j - n], which[j])
        row, at = np.arange(rows), size.copy()
        top, loss, odd = best[at, row], np.full(rows, np.inf), np.zeros(rows, bool)
        steps = []
        while (live := at > 0).any():
            with np.errstate(invalid="ignore"):
                loss = np.where(live, np.minimum(loss, best[at, row] - second[at, row]), loss)
            steps.append(np.where(live, which[at, row], -2))
            odd |= live & (steps[-1] == -1)
            at = at - came[at, row]
        table = np.array(steps[::-1]).T  # a row per word, its pieces in order behind fillers of -2
        return top, loss, table[table > -2], (table > -2).sum(1).cumsum(), odd

    def nbest(self, s: str, n: int) -> list[tuple[float, tuple[str, ...]]]:
        """The ``n`` best (score, pieces) of ``s``, best first, by backward A* search."""
        best, into = self.forward(s)
        out: list[tuple[float, tuple[str, ...]]] = []
        heap: list = [(-best[-1], 0, len(s), 0.0, None)]
        pushed = 0
        while heap and len(out) < n:
            f, _, at, done, path = heapq.heappop(heap)
            while at:  # follow an edge that keeps f, set the others aside
                follow, keeps = None, best[at]
                for i, w in into[at]:
                    if follow is None and keeps - best[i] - w == 0:
                        follow = (i, w)
                    else:
                        pushed += 1
                        heapq.heappush(heap, (-(best[i] + w + done), pushed, i, done + w, (s[i:at], path)))
                done, path, at = done + follow[1], (s[follow[0]:at], path), follow[0]
            pieces = []
            while path:
                pieces.append(path[0])
                path = path[1]
            out.append((-f, tuple(pieces)))
        return out

    def to_ids(self, pieces) -> list[int]:
        ids = list(map(self.ids.get, pieces))
        if None not in ids:
            return ids
        return [i for p, x in zip(pieces, ids) for i in ([x] if x is not None else [self.byte[b] for b in p.encode()])]


class Encoder:
    """N-best segmentations of whole texts."""

    def __init__(self, proof: Proof, n: int, cache_regions: int = CACHE_REGIONS):
        self.lattice, self.n, self.limit = Lattice(proof), n, cache_regions
        self.find = proof.pattern.findall
        self.clear()
        #: region -> (losses, ids) of its n best, for regions that were among the nearest of a text
        self.searched: dict[str, tuple[list[float], list[bytes]]] = {}

    def clear(self) -> None:
        #: region -> place in the lists of best scores, losses of the second best and ids of the best
        self.known: dict[str, int] = {}
        self.scores, self.losses = np.zeros(0), np.zeros(0)
        self.parts: list[bytes] = []

    def _ids(self, pieces) -> bytes:
        return array("I", self.lattice.to_ids(pieces)).tobytes()

    def search(self, region: str) -> tuple[list[float], list[bytes]]:
        if region not in self.searched:
            if len(self.searched) > self.limit // 8:
                self.searched.clear()
            found = self.lattice.nbest(region.replace(" ", MARK), self.n)
            self.searched[region] = [found[0][0] - s for s, _ in found], [self._ids(p) for _, p in found]
        return self.searched[region]

    def prepare(self, texts: list[str]) -> list[list[str]]:
        """Regions of the texts, each known after this call."""
        split = [self.find(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        every = set().union(*split)
        if len(self.known) + len(every) > self.limit:
            self.clear()
        new = [r for r in every if r not in self.known]
        if new:
            scores, losses, parts = self.lattice.first_many([r.replace(" ", MARK) for r in new])
            self.known.update(zip(new, range(len(self.parts), len(self.parts) + len(new))))
            self.scores = np.concatenate([self.scores, scores])
            self.losses = np.concatenate([self.losses, losses])
            self.parts += parts
        return split

    def nbest(self, text: str) -> list[tuple[float, bytes]]:
        """(score, ids as 4-byte unsigned integers) of the n best segmentations, best first."""
        return self.nbest_of(self.prepare([text])[0])

    def nbest_of(self, regions: list[str]) -> list[tuple[float, bytes]]:
        """The same for a text whose regions are prepared."""
        if not regions:
            return [(0.0, b"")]
        at = list(map(self.known.__getitem__, regions))
        parts = list(map(self.parts.__getitem__, at))
        at = np.array(at)
        losses, total = self.losses[at], float(self.scores[at].sum())
        out = [(total, b"".join(parts))]
        # only the n-1 regions with the smallest second loss can differ from the best in the n best
        near = np.argsort(losses, kind="stable")[:self.n - 1] if len(losses) < 64 else np.sort(
            np.argpartition(losses, self.n - 1)[:self.n - 1])
        where = [int(i) for i in near if losses[i] < np.inf]
        options = [self.search(regions[at]) for at in where]
        heap = [(0.0, (0,) * len(where))]
        seen = {heap[0][1]}
        while heap and len(out) < self.n:
            loss, picks = heapq.heappop(heap)
            if any(picks):
                mine = list(parts)
                for at, k, (_, ids) in zip(where, picks, options):
                    mine[at] = ids[k]
                out.append((total - loss, b"".join(mine)))
            for x, (lost, _) in enumerate(options):
                k = picks[x] + 1
                nxt = picks[:x] + (k,) + picks[x + 1:]
                if k < len(lost) and nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (loss - lost[k - 1] + lost[k], nxt))
        return out


class Decoder:
    """Ids back to text: byte pieces become bytes, word marks spaces, the first space goes."""

    def __init__(self, path: str):
        sp = _library(path)
        self.raw = []
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                self.raw.append(bytes([int(sp.id_to_piece(i)[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.raw.append(b"")
            else:
                self.raw.append(sp.id_to_piece(i).replace(MARK, " ").encode())

    def decode(self, ids) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_ENCODERS: dict[tuple, Encoder] = {}
_DECODERS: dict[str, Decoder] = {}


def encode_nbest(docs: DataFrame, model_path: str, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id, rank, score, ids>``: up to ``n`` best segmentations of every whole text, rank from 1.

    A null or empty text has one segmentation, the empty one, of score 0.  A
    text with fewer than ``n`` segmentations has fewer rows.  Equal scores are
    ranked by the order of the search; repeated rows give repeated results.  Other
    columns are not read.
    """
    proof = docs.sparkSession.sparkContext.broadcast(prove(model_path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        key = (proof.value.path, n)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(proof.value, n)
        enc = _ENCODERS[key]

        def fn(keys, texts):
            out: list[list] = [[], [], [], []]
            for k, regions in zip(keys, enc.prepare([t or "" for t in texts])):
                for rank, (score, ids) in enumerate(enc.nbest_of(regions), 1):
                    for col, v in zip(out, (k, rank, score, array("I", ids).tolist())):
                        col.append(v)
            return out

        return fn

    return map_slices(docs.select(F.col(id_col), F.col(text_col)), make,
                      f"`{id_col}` {id_type}, rank int, score double, ids array<int>", rows=64)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for.

    Null ids give null, an empty list the empty text.  Lists of any length are decoded whole; rows (repeated ones too)
    and other columns are kept, but for one named ``out_col``, which is replaced.
    """
    share_code(encoded.sparkSession)

    @pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        if model_path not in _DECODERS:
            _DECODERS[model_path] = Decoder(model_path)
        return ids.map(lambda x: None if x is None else _DECODERS[model_path].decode(x))

    return encoded.withColumn(out_col, text_of(F.col(ids_col)))


def nbest_digest(docs: DataFrame, model_path: str, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The N best of every text, digested where they are made.

    ``<id, rank, score, n_pieces, ids_crc32, decodes>``: ids are not shipped, only their
    number and checksum (little-endian unsigned 32-bit), and whether decoding
    them gives the text back (word marks read as spaces).
    """
    proof = docs.sparkSession.sparkContext.broadcast(prove(model_path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        key = (proof.value.path, n)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(proof.value, n)
        if key[0] not in _DECODERS:
            _DECODERS[key[0]] = Decoder(key[0])
        enc, dec = _ENCODERS[key], _DECODERS[key[0]]

        def fn(keys, texts):
            out: list[list] = [[] for _ in range(6)]
            texts = [t or "" for t in texts]
            for k, t, regions in zip(keys, texts, enc.prepare(texts)):
                for rank, (score, ids) in enumerate(enc.nbest_of(regions), 1):
                    row = (k, rank, score, len(ids) // 4, zlib.crc32(ids),
                           dec.decode(array("I", ids)) == t.replace(MARK, " "))
                    for col, v in zip(out, row):
                        col.append(v)
            return out

        return fn

    return map_slices(docs.select(F.col(id_col), F.col(text_col)), make,
                      f"`{id_col}` {id_type}, rank int, score double, n_pieces bigint, ids_crc32 bigint, decodes boolean")
