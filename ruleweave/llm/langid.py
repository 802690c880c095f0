"""Language identification by a linear-chain conditional random field.

Words of a text are labelled one by one, so code-switched text gets a label per
word.  A word's features are its prefixes, suffixes, inner letter pairs and
triples, and the languages whose lexicon holds it; transitions between the labels
of neighbouring words are learned with them.  Training runs on the driver, on a
bounded sample of labelled rows; prediction runs over every word of every text:
forward-backward over all words of a slice at once, in blocks whose transfer
matrices are chained exactly.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ruleweave.llm.common import SLICE_ROWS, map_slices, share_code



class Words:
    """Runs of letters: word characters but for ``_`` and all that is numeric (digits, fractions, Roman numerals).

    The pattern of runs without decimal digits is quick; only runs with another numeral in them are cut by the exact
    one, whose class lists hundreds of characters that every letter is compared with.
    """

    def __init__(self):
        other = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha()]
        self.runs = re.compile(r"[^\W\d_]+")
        self.exact = re.compile(r"[^\W_" + "".join(map(re.escape, other)) + "]+")

    def findall(self, text: str) -> list[str]:
        found = self.runs.findall(text)
        if not found or "".join(found).isalpha():
            return found
        return [x for w in found for x in ([w] if w.isalpha() else self.exact.findall(w))]

    def finditer(self, text: str) -> Iterator[re.Match]:
        for m in self.runs.finditer(text):
            if m[0].isalpha():
                yield m
            else:
                yield from self.exact.finditer(text, *m.span())


WORD = Words()
UNKNOWN = "und"
#: Bounds of the training sample: rows per language and characters of a row.
SAMPLE_ROWS = 300
SAMPLE_CHARS = 6_000
SAMPLE_PARTS = 16
#: Words per training sequence, and of the stretches of one language in it.
SEQUENCE = 48
STRETCH = (4, 32)
EPOCHS = 6
BATCH = 128
BLOCK = 64
CACHE_WORDS = 400_000
#: A text is foreign to its language under this part of the lexicon share that all but ``RARE`` of the sample reach.
FOREIGN = 0.5
RARE = 0.01
#: Words that every text is credited with at its language's usual share, and texts that a language needs for a floor.
CREDIT = 8
LEAST_TEXTS = 20


#: Cells that features are hashed into, as a power of two.
HASH_BITS = 18
#: Words up to these lengths are hashed together; longer ones alone.
WIDTHS = (8, 16, 32)


def _cells(kind: int, *codes: np.ndarray) -> np.ndarray:
    """Cells of features given by a kind and letters (multiply, shift, keep the top bits)."""
    h = np.full(codes[0].shape, kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for c in codes:
        h = (h ^ c) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - HASH_BITS)).astype(np.int32)


def feature_cells(words: list[str], width: int) -> np.ndarray:
    """Cells of the features of lower-case words of at most ``width`` letters, a row each, padded with ``1 << HASH_BITS``.

    A word's features are its first and last one, two and three letters and its inner pairs and triples.
    """
    codes = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    row, none = np.arange(len(words)), 1 << HASH_BITS
    first = [codes[:, i] if i < width else np.zeros(len(words), np.uint64) for i in range(3)]
    last = [np.where(size > i, codes[row, np.maximum(size - 1 - i, 0)], 0).astype(np.uint64) for i in range(3)]
    out = [np.stack([_cells(kind, *part[:k]) for kind, part in ((1, first), (2, last)) for k in (1, 2, 3)], axis=1)]
    for k in (2, 3):
        if width >= k:
            cells = _cells(2 + k, *[codes[:, i:width - k + 1 + i] for i in range(k)])
            cells[np.arange(width - k + 1)[None, :] > (size - k)[:, None]] = none
            out.append(cells)
    return np.hstack(out)


@dataclass
class Model:
    langs: list[str]
    lexicon: dict[str, int]  # lower-case word -> the set of languages whose lexicon holds it
    sets: np.ndarray  # weights of each such set, [sets, langs]; set 0 is empty
    weights: np.ndarray  # [cells + 1, langs], the last row 0
    transitions: np.ndarray  # [langs, langs], logs
    start: np.ndarray
    usual: np.ndarray  # share of a language's words that a lexicon of other texts holds
    floors: np.ndarray  # least such share of a text that is taken for the language
    cache: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "table": None}

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission scores of distinct words."""
        low = [w.lower() for w in words]
        out = self.sets[np.fromiter((self.lexicon.get(w, 0) for w in low), np.int64, len(low))].astype(np.float32)
        size = np.fromiter(map(len, low), np.int64, len(low))
        floor = 0
        for width in WIDTHS:
            at = np.flatnonzero((size > floor) & (size <= width))
            for lo in range(0, len(at), 8192):
                part = at[lo:lo + 8192]
                out[part] += self.weights[feature_cells([low[i] for i in part], width)].sum(1)
            floor = width
        for i in np.flatnonzero(size > floor):
            out[i] += self.weights[feature_cells([low[i]], int(size[i]))].sum((0, 1))
        return out

    def emissions(self, texts: list[list[str]]) -> np.ndarray:
        """Emission scores of all words, text after text."""
        k = len(self.langs)
        if self.table is None or len(self.cache) > CACHE_WORDS:
            self.cache, self.table = {}, np.zeros((0, k), np.float32)
        cache = self.cache
        new = [w for w in set().union(*texts) if w not in cache]
        if new:
            cache.update(zip(new, range(len(cache), len(cache) + len(new))))
            self.table = np.vstack([self.table, self.scores(new)])
        at = [i for ws in texts for i in map(cache.__getitem__, ws)]
        return self.table[np.array(at, dtype=np.int64)] if at else np.zeros((0, k), np.float32)

    def posteriors(self, texts: list[list[str]]) -> np.ndarray:
        """Label probabilities of every word, text after text."""
        first = np.zeros(sum(map(len, texts)), dtype=bool)
        starts = np.cumsum([0] + [len(ws) for ws in texts])[:-1]
        first[[s for s, ws in zip(starts, texts) if ws]] = True
        return forward_backward(self.emissions(texts), first, self.transitions, self.start)


def forward_backward(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Posterior label probabilities of a chain of words.

    ``first`` marks the first word of each text; there the step forgets the word
    before (a matrix with equal rows), so texts of any length share one chain.  The
    chain is cut into blocks: the blocks' transfer matrices are multiplied in
    lockstep, messages pass from block to block, and a second pass inside the blocks
    gives every word's forward and backward message.
    """
    n, k = emit.shape
    if not n:
        return np.zeros((0, k))
    e = np.exp(emit - emit.max(1, keepdims=True)).astype(np.float64)
    a, pi = np.exp(trans), np.exp(start)
    blocks = -(-n // block)
    pad = blocks * block - n
    if pad:  # neutral words behind the last text
        e = np.vstack([e, np.ones((pad, k))])
        first = np.concatenate([first, np.zeros(pad, bool)])
        first[n] = True
    e, first = e.reshape(blocks, block, k), first.reshape(blocks, block)

    def step(m: np.ndarray, s: int) -> np.ndarray:
        """Row messages ``m [blocks, ..., k]`` moved over word s of each block."""
        out = m @ a
        if first[:, s].any():
            hit = first[:, s]
            out[hit] = m[hit].sum(-1, keepdims=True) * pi
        out *= e[:, s].reshape((blocks,) + (1,) * (m.ndim - 2) + (k,))
        return out

    whole = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for s in range(block):
        whole = step(whole, s)
        whole /= whole.max((1, 2), keepdims=True)
    into, back = np.empty((blocks, k)), np.empty((blocks, k))
    v = np.full(k, 1.0 / k)
    for b in range(blocks):
        into[b] = v
        v = v @ whole[b]
        v /= v.sum()
    v = np.ones(k)
    for b in range(blocks - 1, -1, -1):
        back[b] = v
        v = whole[b] @ v
        v /= v.max()
    alpha = np.empty((block, blocks, k))
    m = into
    for s in range(block):
        m = step(m, s)
        m /= m.sum(1, keepdims=True)
        alpha[s] = m
    m = back
    for s in range(block - 1, -1, -1):
        alpha[s] *= m
        seen = e[:, s] * m
        m = seen @ a.T
        if first[:, s].any():
            hit = first[:, s]
            m[hit] = (seen[hit] @ pi)[:, None]
        m /= m.max(1, keepdims=True)
    out = alpha.transpose(1, 0, 2).reshape(blocks * block, k)[:n]
    return out / out.sum(1, keepdims=True)


def code_switched(rows: list[tuple[list[str], int]], rng: np.random.Generator) -> list[tuple[list[str], list[int]]]:
    """Training sequences: stretches of the sampled texts, dealt in random order so that labels change inside a sequence."""
    parts = []
    for ws, y in rows:
        at = 0
        while at < len(ws):
            n = int(rng.integers(*STRETCH))
            parts.append((ws[at:at + n], y))
            at += n
    rng.shuffle(parts)
    words = [w for ws, _ in parts for w in ws]
    labels = [y for ws, y in parts for _ in ws]
    return [(words[i:i + SEQUENCE], labels[i:i + SEQUENCE]) for i in range(0, len(words), SEQUENCE)]


def lexicon_words(rows: list[tuple[list[str], int]]) -> dict[str, tuple[int, ...]]:
    """Lower-case words that two texts of one language hold, with all languages that they occur in."""
    seen: dict[str, Counter] = {}
    for ws, y in rows:
        for w in {w.lower() for w in ws}:
            seen.setdefault(w, Counter())[y] += 1
    return {w: tuple(sorted(c)) for w, c in seen.items() if max(c.values()) >= 2}


def n_known(words: list[str], lexicon: dict) -> int:
    """How many of the words a lexicon holds, of whatever language."""
    return sum(w.lower() in lexicon for w in words)


def lexicon_floors(rows: list[tuple[list[str], int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Usual lexicon share of each language's words, and the share under which a text is foreign to it.

    Every text is looked up in the lexicon of the other half of the sample, so the shares are those of unseen
    texts.  A language of few texts, or one whose words do not recur (no spaces between words), gets a floor at or near 0.
    """
    halves = lexicon_words(rows[1::2]), lexicon_words(rows[0::2])
    found: list[list[tuple[int, int]]] = [[] for _ in range(k)]
    for i, (ws, y) in enumerate(rows):
        if ws:
            found[y].append((n_known(ws, halves[i % 2]), len(ws)))
    usual, floors = np.zeros(k), np.zeros(k)
    for y, pairs in enumerate(found):
        if len(pairs) < LEAST_TEXTS:
            continue
        known, size = np.array(pairs, dtype=float).T
        usual[y] = known.sum() / size.sum()
        floors[y] = FOREIGN * np.quantile((known + CREDIT * usual[y]) / (size + CREDIT), RARE)
    return usual, floors


def train(rows: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Fit on (text, language) rows by Adagrad on the conditional log-likelihood."""
    langs = sorted({y for _, y in rows})
    k = len(langs)
    code = {y: i for i, y in enumerate(langs)}
    split = [(WORD.findall(t), code[y]) for t, y in rows]
    known = lexicon_words(split)
    combos = [(), *sorted(set(known.values()))]
    lexicon = {w: combos.index(c) for w, c in known.items()}
    cells = 1 << HASH_BITS
    trans, start = np.zeros((k, k)), np.zeros(k)
    model = Model(langs, lexicon, np.zeros((len(combos), k)), np.zeros((cells + 1, k), np.float32), trans, start,
                  *lexicon_floors(split, k))
    if k < 2:
        return model
    split = [([w.lower() for w in ws if len(w.lower()) <= WIDTHS[-1]], y) for ws, y in split]
    vocab = {w: i for i, w in enumerate(sorted({w for ws, _ in split for w in ws}))}
    table = feature_cells(list(vocab), WIDTHS[-1])
    used, table = np.unique(table, return_inverse=True)  # train on the cells that occur
    table = table.reshape(len(vocab), -1)
    wide = table.shape[1]
    sets = np.fromiter((lexicon.get(w, 0) for w in vocab), np.int64, len(vocab))
    weights, lex = np.zeros((len(used), k)), np.zeros((len(combos), k))
    pad = used == cells
    rng = np.random.default_rng(seed)
    sequences = code_switched(split, rng)
    g2, l2, t2 = np.full_like(weights, 1e-2), np.full_like(lex, 1e-2), np.full_like(trans, 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(sequences))
        for b in range(0, len(order), BATCH):
            part = [sequences[i] for i in order[b:b + BATCH]]
            ids = np.array([vocab[w] for ws, _ in part for w in ws])
            gold = np.array([y for _, ys in part for y in ys])
            first = np.zeros(len(ids), bool)
            first[np.cumsum([0] + [len(ws) for ws, _ in part])[:-1]] = True
            emit = weights[table[ids]].sum(1) + lex[sets[ids]]
            post = forward_backward(emit, first, trans, start)
            d = -post
            d[np.arange(len(ids)), gold] += 1
            words, inv = np.unique(ids, return_inverse=True)
            by = np.zeros((len(words), k))
            np.add.at(by, inv, d)
            grad = np.zeros_like(weights)
            np.add.at(grad, table[words].ravel(), np.repeat(by, wide, axis=0))
            grad = grad / len(part) - 1e-4 * weights
            grad[pad] = 0
            g2 += grad ** 2
            weights += 0.3 * grad / np.sqrt(g2)
            grad = np.zeros_like(lex)
            np.add.at(grad, sets[words], by)
            grad = grad / len(part) * (np.arange(len(combos)) > 0)[:, None] - 1e-4 * lex
            l2 += grad ** 2
            lex += 0.3 * grad / np.sqrt(l2)
            # transitions: observed less expected neighbours
            inner = np.flatnonzero(~first)
            seen2 = np.zeros((k, k))
            np.add.at(seen2, (gold[inner - 1], gold[inner]), 1)
            expect = pair_expectation(emit, post, first, trans)
            gt = (seen2 - expect) / len(part) - 1e-4 * trans
            t2 += gt ** 2
            trans += 0.3 * gt / np.sqrt(t2)
    model.weights[used], model.sets, model.transitions = weights, lex, trans
    return model


def pair_expectation(emit: np.ndarray, post: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Expected label pairs of neighbouring words.

    With the word before marginalised, P(i, j) is proportional to
    alpha_i exp(trans_ij) rho_j, where rho is the right word's evidence; both are had
    from its posterior by proportional fitting (the pair table has the two posteriors
    as margins and exp(trans) as its odds ratios, which determines it).
    """
    inner = np.flatnonzero(~first)
    if not len(inner):
        return np.zeros_like(trans)
    left, right = post[inner - 1], post[inner]
    a = np.exp(trans)
    r, c = np.ones_like(left), np.ones_like(right)
    for _ in range(12):
        r = left / np.maximum(c @ a.T, 1e-12)
        c = right / np.maximum(r @ a, 1e-12)
    return np.einsum("ni,ij,nj->ij", r, a, c)


def sample_rows(docs: DataFrame, rows_per_lang: int, max_chars: int, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """At most ``rows_per_lang`` different labelled texts of each language, of at most ``max_chars`` characters, by a hash of the text."""
    fit = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) <= max_chars))
    fit = fit.select(F.col(text_col).alias("t"), F.col(lang_col).alias("y")).withColumn("h", F.xxhash64("t"))
    # copies are one row before the rank; the texts of the picked hashes are read again, so only hashes are dealt
    each = fit.select("y", "h").distinct()
    # a language's hashes are dealt over parts, of which each gives its first ones: no task orders a whole language
    part = each.withColumn("part", F.pmod(F.col("h"), F.lit(SAMPLE_PARTS)))
    for by in (["y", "part"], ["y"]):
        first = Window.partitionBy(*by).orderBy("h")
        part = part.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= rows_per_lang).drop("r")
    picked = part.select("y", "h")
    found = fit.join(F.broadcast(picked), ["y", "h"]).groupBy("y", "h").agg(F.min("t").alias("t"))
    return sorted((r.t, r.y) for r in found.select("t", "y").collect())


def held_out(id_col: str = "doc_id") -> "F.Column":
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0 (a null id is not held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, rows_per_lang: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the labelled rows that are not held out."""
    rows = sample_rows(docs.filter(~held_out(id_col)), rows_per_lang, max_chars, id_col, text_col, lang_col)
    return train(rows)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id, lang_pred, score, n_words>``: the language with the largest share of word labels, and that share.

    ``und`` with score 0 where the text is null or has no letter, or the model
    knows no language.  Equal shares go to the language first in the alphabet.  All
    words of a text count; other columns are not read; repeated rows get
    repeated results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        return lambda ids, texts: [ids, *judge(shared.value, texts)]

    return map_slices(docs.select(F.col(id_col), F.col(text_col)), make,
                      f"`{id_col}` {id_type}, lang_pred string, score double, n_words bigint")


def judge(m: Model, texts: list) -> tuple[list[str], list[float], list[int]]:
    """Language, share of its labels and number of words of each text."""
    return judge_words(m, split_words(texts))


def split_words(texts: list) -> list[list[str]]:
    return [WORD.findall(t) if t else [] for t in texts]


def judge_words(m: Model, ws: list[list[str]]) -> tuple[list[str], list[float], list[int]]:
    """:func:`judge` for texts given by their words."""
    sizes = [len(w) for w in ws]
    if not m.langs:
        return [UNKNOWN] * len(ws), [0.0] * len(ws), sizes
    total = np.vstack([np.zeros((1, len(m.langs))), np.cumsum(m.posteriors(ws), axis=0)])
    ends = np.cumsum([0] + sizes)
    share = (total[ends[1:]] - total[ends[:-1]]) / np.maximum(np.array(sizes), 1)[:, None]
    best = share.argmax(1)
    score = np.clip(share.max(1), 0, 1)
    return ([m.langs[b] if n else UNKNOWN for b, n in zip(best, sizes)],
            [float(s) if n else 0.0 for s, n in zip(score, sizes)], sizes)


def identified(m: Model, texts: list, least: float = 1 / 3) -> list[bool]:
    """Whether each text is in a learned language, or switches between learned ones.

    One language must hold the share ``least`` of the word labels.  As labels only weigh the learned languages
    against each other, the lexicons must also know enough of the text: words of any learned language count, short
    texts are credited with ``CREDIT`` usual words, and the floor is that of the language of most labels.
    """
    out = []
    code = {y: i for i, y in enumerate(m.langs)}
    split = split_words(texts)
    for words, lang, share, n in zip(split, *judge_words(m, split)):
        if lang == UNKNOWN or share < least:
            out.append(False)
            continue
        y = code[lang]
        known = n_known(words, m.lexicon) if m.floors[y] else 0
        out.append((known + CREDIT * m.usual[y]) / (n + CREDIT) >= m.floors[y])
    return [bool(x) for x in out]


def keep_identified(docs: DataFrame, model: Model, least: float = 1 / 3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is :func:`identified`, with all their columns whatever their names.

    Texts that are null, empty or without a letter go, and all of them if the model knows no language; a text's own
    label is not read.  Equal rows share one fate, all words of a long text count, an empty table stays empty.
    """
    share_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("boolean")
    def keeps(texts: pd.Series) -> pd.Series:
        out: list[bool] = []
        for at in range(0, len(texts), SLICE_ROWS):
            out += identified(shared.value, texts.iloc[at:at + SLICE_ROWS].tolist(), least)
        return pd.Series(out, dtype=bool)

    return docs.filter(keeps(F.col(text_col)))


def label_words(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id, start, end, word, lang, score>`` for every word of every text (code points, end exclusive).

    Texts that are null, empty or without a letter give no row, nor does any text if the model knows no language.
    Equal scores go to the language first in the alphabet; repeated rows give repeated results; other columns are
    not read; long texts are labelled whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def make():
        m: Model = shared.value

        def fn(ids, texts):
            found = [list(WORD.finditer(t)) if t and m.langs else [] for t in texts]
            post = m.posteriors([[x[0] for x in f] for f in found]) if m.langs else np.zeros((0, 0))
            flat = [(i, x) for i, f in zip(ids, found) for x in f]
            best = post.argmax(1) if len(flat) else []
            return [[i for i, _ in flat], [x.start() for _, x in flat], [x.end() for _, x in flat],
                    [x[0] for _, x in flat], [m.langs[b] for b in best], [float(p[b]) for p, b in zip(post, best)]]

        return fn

    return map_slices(docs.select(F.col(id_col), F.col(text_col)), make,
                      f"`{id_col}` {id_type}, start bigint, `end` bigint, word string, lang string, score double")
