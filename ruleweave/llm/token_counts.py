"""Token counts of a BPE piece model by the whole-token shortcut.

Offline, :func:`prove` looks at the vocabulary once: it checks that no piece
holds a word mark after another character and finds characters that no
multi-character piece holds.  Merges can therefore never cross from one
*region* (a run of spaces and the characters up to the next space or lone
character) into the next, and the count of a text is the sum over its regions.
It then encodes every vocabulary string alone, at the start of a word and
inside one, and keeps those that come out as one token.  At run time a region
that is such a string counts 1 without any merging; only the other regions go
through the library, each distinct one once per cache life.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.common import map_slices

MARK = "▁"
#: Regions remembered per Python worker before the cache is emptied.
CACHE_REGIONS = 400_000


@dataclass(frozen=True)
class Proof:
    """What was shown about one model: lone characters and strings that are one token."""

    path: str
    lone: str
    whole: frozenset[str]

    @property
    def pattern(self) -> re.Pattern:
        lone = re.escape(self.lone)
        return re.compile(f" *[^ {lone}]+| +|[{lone}]" if lone else " *[^ ]+| +")


def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def normal_pieces(sp) -> dict[str, int]:
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))}


def region_counts(sp, regions: list[str], lead: str) -> list[int]:
    """Tokens of each region inside a text.

    A region that begins with a space stands after the library's own word mark;
    any other is encoded behind a lone character, whose two tokens (word mark,
    byte) are taken off.  A single space is encoded that way too, as the library drops empty texts.
    """
    plain = [r[0] == " " and r != " " for r in regions]
    out = sp.encode([r[1:] if p else lead + r for r, p in zip(regions, plain)], num_threads=1)
    return [len(ids) if p else len(ids) - 2 for p, ids in zip(plain, out)]


def prove(path: str) -> Proof:
    sp = _library(path)
    pieces = normal_pieces(sp)
    crossing = [p for p in pieces if MARK in p.lstrip(MARK)]
    if crossing or sp.encode("a b", out_type=str)[0][0] != MARK or len(sp.encode(f"x{MARK}y")) != len(sp.encode("x y")):
        raise ValueError("the model merges across spaces; regions are not independent")
    inside = set("".join(pieces))
    lone = "".join(c for c in "\n\t\r\x0b\x0c" if c not in inside and len(sp.encode(c)) == 2)
    if "\n" not in lone:
        raise ValueError("the model has pieces with line feeds; regions are not independent")
    strings = [" " * (len(p) - len(p.lstrip(MARK))) + p.lstrip(MARK) for p in pieces]
    strings = [s for s in strings if s.strip(" ")]
    whole = frozenset(s for s, n in zip(strings, region_counts(sp, strings, "\n")) if n == 1)
    return Proof(path, lone, whole)


class Counter:
    """Counts tokens of texts; keeps counts of regions it has merged."""

    def __init__(self, proof: Proof, cache_regions: int = CACHE_REGIONS):
        self.sp, self.proof, self.limit = _library(proof.path), proof, cache_regions
        self.find = proof.pattern.findall
        self.known: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        self.known = dict.fromkeys(self.proof.whole, 1)
        self.known |= dict.fromkeys(self.proof.lone, 1)

    def regions(self, text: str) -> list[str]:
        return self.find(" " + text.replace(MARK, " ")) if text else []

    def counts(self, texts: list[str]) -> list[int]:
        out = []
        for text in texts:
            regions = self.regions(text)
            new = [r for r in set(regions) if r not in self.known]
            if new:
                if len(self.known) + len(new) > self.limit:
                    self.reset()
                    new = [r for r in set(regions) if r not in self.known]
                self.known.update(zip(new, region_counts(self.sp, new, "\n")))
            out.append(sum(map(self.known.__getitem__, regions)))
        return out


_COUNTERS: dict[str, Counter] = {}


def _counter(proof: Proof) -> Counter:
    if proof.path not in _COUNTERS:
        _COUNTERS[proof.path] = Counter(proof)
    return _COUNTERS[proof.path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``<id, n_bytes, n_tokens, over_limit>``, one row per input row.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null ids
    are counted like any other row; other columns are not read.  Texts are
    counted whole.  The proof (at most one string per vocabulary entry) is
    broadcast.
    """
    proof = docs.sparkSession.sparkContext.broadcast(prove(model_path))

    def make():
        counter = _counter(proof.value)

        def fn(ids, texts):
            texts = [t or "" for t in texts]
            n = counter.counts(texts)
            return [ids, [len(t.encode()) for t in texts], n, [x > limit for x in n]]

        return fn

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_slices(docs.select(F.col(id_col), F.col(text_col)), make,
                      f"`{id_col}` {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
