"""Packing, language ID, quality, near-dedup, neighbours, WARC and the pipeline: against brute force and on edge rows."""

from __future__ import annotations

import collections
import gzip
import hashlib
import io
import itertools
import os
import random
import re
import sys
import time
import zlib

import numpy as np
import pytest

from conftest import ROOT, SF_SMALL
from oracle_harness import compare, duck
from ruleweave.llm import ann, common, langid, neardup, packing, quality, queries, secrets, warc

sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.01"
LONG = "word " * 30_000


def documents(spark, rows):
    """Documents with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, y, "s", 1, 2) for i, t, y in rows],
                                 "doc_id long, text string, lang string, source string, score int, ids int")


EDGE = [(None, "nothing in the way of a name", "en"), (1, None, "en"), (2, "", None), (3, LONG, "en"), (4, "a b c", "de"),
        (4, "a b c", "de"), (5, "12 34 !?", "en")]


# ---- packing ----

def neighbours_on_curve(bits, dims):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = packing.hilbert_index(points, bits)
    assert sorted(keys) == list(range(len(points)))
    walk = points[np.argsort(keys)]
    return np.abs(np.diff(walk, axis=0)).sum(1)


@pytest.mark.parametrize("bits,dims", [(1, 2), (3, 2), (2, 3), (2, 4)])
def test_curve_visits_neighbours(bits, dims):
    assert (neighbours_on_curve(bits, dims) == 1).all()


def test_same_texts_share_a_place(spark):
    docs = documents(spark, [(1, "one text of some words", "en"), (2, "another, quite unlike", "en"), (3, "one text of some words", "en")])
    at = {r.doc_id: r.curve for r in packing.pack(docs, **queries.BYTE_BPE).collect()}
    assert at[1] == at[3] != at[2]


def check_pieces(rows, texts, length=1024):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.BYTE_BPE["json_path"])
    want = collections.Counter()
    for key, text in texts:
        want[key, tuple([*library.encode(text or "", add_special_tokens=False).ids, 0])] += 1
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for s, part in sequences.items():
        part.sort(key=lambda r: r.offset)
        at = 0
        for r in part:
            assert r.offset == at
            at += r.length
        assert at == length or s == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))
    single = {key: ids for (key, ids), n in want.items() if sum(k == key for k, _ in texts) == 1}
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for key, ids in single.items():
        at = 0
        for r in sorted(by[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_packing_query(spark):
    rows = queries.op2_packing(spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    check_pieces(rows, [(d.doc_id, d.text) for d in docs])


def test_packing_edges(spark):
    extra = [*EDGE, (7, "<|endoftext|> a <|endoftext|>", "en"), (8, "漢字 и кириллица 🙂  ", "en")]
    rows = packing.pack(documents(spark, extra), **queries.BYTE_BPE).collect()
    check_pieces(rows, [(i, t) for i, t, _ in extra])
    assert sum(r.length == 1 and r.doc_tokens == 1 for r in rows) == 2  # null and empty
    assert packing.pack(documents(spark, EDGE).limit(0), **queries.BYTE_BPE).count() == 0


# ---- language ID ----

def chain(emit, first, trans, start):
    """Posteriors by enumeration of all label sequences of one text."""
    n, k = emit.shape
    total = np.zeros((n, k))
    for ys in itertools.product(range(k), repeat=n):
        s = start[ys[0]] + sum(emit[t, y] for t, y in enumerate(ys)) + sum(trans[a, b] for a, b in zip(ys, ys[1:]))
        for t, y in enumerate(ys):
            total[t, y] += np.exp(s)
    return total / total.sum(1, keepdims=True)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    for block in (2, 3, 64):
        sizes = [1, 4, 2, 5, 3]
        k = 3
        emit = rng.standard_normal((sum(sizes), k))
        trans, start = rng.standard_normal((k, k)), rng.standard_normal(k)
        first = np.zeros(sum(sizes), bool)
        ends = np.cumsum([0, *sizes])
        first[ends[:-1]] = True
        got = langid.forward_backward(emit, first, trans, start, block)
        want = np.vstack([chain(emit[a:b], None, trans, start) for a, b in zip(ends, ends[1:])])
        np.testing.assert_allclose(got, want, rtol=1e-6)


def test_pair_expectation_equals_enumeration():
    rng = np.random.default_rng(5)
    k, n = 3, 5
    emit, trans, start = rng.standard_normal((n, k)), rng.standard_normal((k, k)), np.zeros(k)
    first = np.arange(n) == 0
    want = np.zeros((k, k))
    z = 0.0
    for ys in itertools.product(range(k), repeat=n):
        w = np.exp(sum(emit[t, y] for t, y in enumerate(ys)) + sum(trans[a, b] for a, b in zip(ys, ys[1:])))
        z += w
        for a, b in zip(ys, ys[1:]):
            want[a, b] += w
    post = langid.forward_backward(emit, first, trans, start)
    np.testing.assert_allclose(langid.pair_expectation(emit, post, first, trans), want / z, rtol=1e-3)


def test_held_out_accuracy_and_code_switch(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in queries.op4_language_id(spark, SF).collect()}
    rows = docs.collect()
    assert all(got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0) for d in rows)
    held = [d for d in rows if got[d.doc_id].held_out]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    model = langid.fit(docs)
    assert (np.diag(model.transitions)[:, None] >= model.transitions).all()  # staying is learned to be likelier
    by = {y: max((d.text for d in held if d.lang == y), key=len).split()[:40] for y in ("en", "de")}
    mixed = documents(spark, [(1, " ".join(by["en"] + by["de"]), None)])
    labels = [r.lang for r in langid.label_words(mixed, model).orderBy("start").collect()]
    half = len(langid.WORD.findall(" ".join(by["en"])))
    assert labels[:half].count("en") > 0.9 * half and labels[half:].count("de") > 0.9 * (len(labels) - half)


def test_prediction_ignores_other_columns(spark):
    docs = documents(spark, [(i, "the cat and the dog of it" if i % 2 else "der hund und die katze das", "en" if i % 2 else "de")
                             for i in range(40)])
    model = langid.fit(docs)
    a = langid.predict(docs, model).collect()
    assert {(r.doc_id % 2, r.lang_pred) for r in a} == {(1, "en"), (0, "de")}


def test_copies_do_not_fill_the_sample(spark):
    """A text of many copies, first by hash in its language, takes one place of the sample."""
    from pyspark.sql import functions as F

    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("the cat dog of and house sees runs small green".split()) for _ in range(12)), "en") for i in range(60)]
    rows += [(100 + i, " ".join(rng.choice("der hund katze das und haus sieht klein mit".split()) for _ in range(12)), "de") for i in range(60)]
    docs = documents(spark, rows)
    front = docs.filter("lang = 'en'").orderBy(F.xxhash64("text")).first().text
    copied = docs.unionByName(documents(spark, [(1000 + i, front, "en") for i in range(50)]))
    pick = lambda d: langid.sample_rows(d, 20, 6_000, "doc_id", "text", "lang")
    assert pick(copied) == pick(docs)
    for y in ("en", "de"):  # the first ones of the whole language, whatever the parts
        want = docs.filter(F.col("lang") == y).select("text").distinct().orderBy(F.xxhash64("text")).limit(20).collect()
        assert sorted(r.text for r in want) == sorted(t for t, lang in pick(docs) if lang == y)
    assert len(set(pick(copied))) == len(pick(copied)) == 40


def test_language_edges(spark):
    docs = documents(spark, EDGE)
    rows = langid.predict(docs, langid.fit(docs)).collect()
    assert len(rows) == len(EDGE)
    assert sorted(r.doc_id for r in rows if r.lang_pred == "und") == [1, 2, 5]
    nothing = langid.fit(docs.limit(0))
    assert nothing.langs == [] and {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), langid.fit(docs)).count() == 0
    assert langid.keep_identified(docs, langid.fit(docs)).columns == docs.columns


def made_text(rng, frequent: str, parts: str, n: int) -> str:
    """Words of a made-up language: half of them frequent ones, half joined from its syllables."""
    frequent, parts = frequent.split(), parts.split()
    return " ".join(rng.choice(frequent) if rng.random() < 0.5 else "".join(rng.choice(parts) for _ in range(3)) for _ in range(n))


LEARNED = {"aa": ("ta ro mi sel nov ab", "ka le ti mo ra su"), "bb": ("und der vek os im zu", "sch ber ung gel tig ken"),
           "cc": ("lo qui eth ama por vi", "cio nte are lia pro dis")}
UNLEARNED = ("jest nie szy dla tylko byc", "krz wsk czy prz ola dzi")


def test_unlearned_language_is_rejected(spark):
    """Labels alone give every text a learned language; the lexicons tell texts of another one, and keep code-switched ones."""
    rng = random.Random(11)
    rows = [(i, made_text(rng, *LEARNED[y], rng.randint(5, 120)), y) for i, y in enumerate(sorted(LEARNED) * 80)]
    model = langid.fit(documents(spark, rows))
    assert (model.floors > 0).all() and (model.floors < model.usual).all()
    own = [made_text(rng, *LEARNED[y], n) for y in LEARNED for n in (1, 2, 5, 20, 400) for _ in range(10)]
    assert all(langid.identified(model, own))
    mixed = [made_text(rng, *LEARNED["aa"], 30) + " " + made_text(rng, *LEARNED["cc"], 30) for _ in range(20)]
    assert all(langid.identified(model, mixed))
    other = [made_text(rng, *UNLEARNED, n) for n in (60, 300) for _ in range(20)]
    assert not any(langid.identified(model, other))
    langs, shares, _ = langid.judge(model, other)
    assert min(shares) >= 1 / 3 and "und" not in langs  # the share of the labels alone keeps them all
    docs = documents(spark, [(1, own[0], None), (2, other[0], "aa"), (3, None, "aa"), (4, "", None), (5, "12 %", "bb"), (6, mixed[0], None)])
    clash = docs.withColumnsRenamed({"source": "keeps"})
    assert sorted(r.doc_id for r in langid.keep_identified(clash, model).collect()) == [1, 6]
    assert langid.keep_identified(clash, model).columns == clash.columns


def test_floor_needs_recurring_words():
    """A language of few texts, or whose words never recur, has no floor: nothing is foreign to it."""
    rng = random.Random(12)
    few = [(made_text(rng, *LEARNED["aa"], 40).split(), 0) for _ in range(langid.LEAST_TEXTS - 1)]
    once = [(["".join(rng.choice("abcdefghij") for _ in range(24)) for _ in range(10)], 1) for _ in range(60)]
    usual, floors = langid.lexicon_floors(few + once, 3)
    assert floors.tolist() == [0.0, 0.0, 0.0] and usual[2] == 0


# ---- quality ----

def brute_base(text):
    word = re.compile("[^\x20\x09-\x0D]+")
    w = word.findall(text or "")
    grams = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if word.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_columns(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a ", "b ", "cc\n", "é\t", "#", "|x ", "\n", "\x0b", "\xa0", "a b a b a b a b a "]) for _ in range(rng.randint(0, 120)))
             for _ in range(120)]
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    rows = quality.score_quality(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_base(texts[r.doc_id])
        assert tuple(r[c] for c in BASE) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed and r.kept == (not failed)  # without marks nothing goes by score


def test_scores_equal_a_plain_model(spark):
    """The ratio recomputed in Python from the cells that Spark hashes."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    grams = quality.hashed_words(docs, F.col("text")).select("doc_id", quality.grams().alias("g"),
                                                             quality.fold(quality.text_hash(F.col("text"))).alias("f")).collect()
    marks = {r.doc_id: r.quality for r in labels.collect()}
    cells = {r.doc_id: [h % quality.BUCKETS for h in r.g] for r in grams}
    raw, target = collections.Counter(), [collections.Counter(), collections.Counter()]
    for r in grams:
        raw.update(cells[r.doc_id])
        if marks.get(r.doc_id) == 1:
            target[r.f].update(cells[r.doc_id])
    n, k = sum(raw.values()), len(raw)

    def model(counts):
        t = sum(counts.values())
        return {c: round((np.log((counts[c] + 1) / (t + k)) - np.log((raw[c] + 1) / (n + k))) * quality.GRID) for c in raw}

    def llr(w, r):
        at = cells[r.doc_id]
        return sum(w[c] for c in at) / len(at) / quality.GRID if at else 0.0

    got = {r.doc_id: r for r in quality.score_quality(docs, labels).collect()}
    whole = model(target[0] + target[1])  # all trusted texts
    other = [model(target[1]), model(target[0])]
    steps = collections.defaultdict(lambda: [0, 0])
    for r in grams:
        assert abs(got[r.doc_id].llr - llr(whole, r)) < 1e-5
        assert got[r.doc_id].kept == (not got[r.doc_id].base_failed and got[r.doc_id].llr >= got[r.doc_id].threshold)
        if not got[r.doc_id].base_failed and r.doc_id in marks:
            steps[np.floor(llr(other[r.f], r) / quality.STEP)][marks[r.doc_id]] += 1
    bad, good = (sum(x[q] for x in steps.values()) for q in (0, 1))
    gain = {s: sum(x[0] for z, x in steps.items() if z < s) / bad - sum(x[1] for z, x in steps.items() if z < s) / good for s in steps}
    assert {r.threshold for r in got.values()} == {min(gain, key=lambda s: (-gain[s], s)) * quality.STEP}


def test_trusted_rows_stay(spark):
    rows = queries.op8_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    passed = [r for r in rows if not r.base_failed]
    good = [r.kept for r in passed if r.quality == 1]
    bad = [r.kept for r in passed if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.25 * len(bad)


def test_quality_is_native(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    plan = quality.score_quality(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_edges(spark):
    docs = documents(spark, EDGE)
    marks = spark.createDataFrame([(1, 1), (3, 1), (3, 0), (4, None), (None, 1)], "doc_id long, quality int")
    rows = quality.score_quality(docs, marks).collect()
    assert len(rows) == len(EDGE) and sum(r.n_words == 0 for r in rows) == 2
    assert quality.score_quality(docs.limit(0), marks).count() == 0
    assert quality.keep_good(docs, marks).columns == docs.columns


# ---- near duplicates ----

def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, y in enumerate(b, 1):
            c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
        p = c
    return p[-1]


def test_banded_distance_equals_the_table():
    rng = random.Random(0)
    for _ in range(3000):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        b = list(a) if rng.random() < 0.6 else [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        for _ in range(rng.randint(0, 4)):
            b.insert(rng.randint(0, len(b)), rng.choice("abc"))
            if rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
        limit = rng.randint(0, 8)
        assert neardup.banded_distance(a, b, limit) == min(distance(a, b), limit + 1)


def test_sketch_keeps_order_and_occurrence():
    hasher, seed = neardup.Hasher(), neardup.seeds(16)
    of = lambda words: neardup.sketch(neardup.kmers(hasher(words)), seed)
    a = [f"w{i}" for i in range(60)]
    b = a[30:] + a[:30]  # the same words and nearly the same k-mers, in another order
    assert (of(a) == of(list(a))).all()
    kmers_a, kmers_b = (set(neardup.kmers(hasher(x)).tolist()) for x in (a, b))
    assert len(kmers_a & kmers_b) >= 50
    assert (of(a) == of(b)).mean() < 0.75
    twice = neardup.kmers(hasher(a + a))
    assert len(set(twice.tolist())) == len(twice)  # occurrences are told apart


def planted(rng):
    vocabulary = [f"t{i}" for i in range(4000)]
    rows, groups = [], []
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for g in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 400))]
        members = [base]
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            members.append(copy)
        ids = []
        for m in members:
            ids.append(len(rows))
            rows.append((len(rows), " ".join(m), "en"))
        groups.append(ids)
    for _ in range(15):  # share a passage, not near copies
        own = [rng.choice(vocabulary) for _ in range(90)]
        groups.append([len(rows)])
        rows.append((len(rows), " ".join(own[:45] + passage + own[45:]), "en"))
    return rows, groups


def test_classes_of_planted_copies(spark):
    rows, groups = planted(random.Random(4))
    got = {r.doc_id: r for r in neardup.near_duplicates(documents(spark, rows)).collect()}
    for ids in groups:
        assert {got[i].class_id for i in ids} == {min(ids)}
    assert len({r.class_id for r in got.values()}) == len(groups)


def test_near_duplicate_query(spark):
    """Classes hold every brute-force link, and only texts joined by links."""
    got = {r.doc_id: r.class_id for r in queries.op1_minhash_near_dedup(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    words = {d.doc_id: neardup.words_of(d.text) for d in docs}
    parent = {i: i for i in words}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(words), 2):
        if neardup.edit_similarity(words[a], words[b]) is not None:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {i: root(i) for i in words} == got


def template_family(rng):
    """Texts on one template, under 0.8 to each other, and planted pairs of them at about 0.87."""
    vocabulary = [f"t{i}" for i in range(6000)]
    template = [rng.choice(vocabulary) for _ in range(210)]
    texts, planted = [], []
    for i in range(60):
        own = [rng.choice(vocabulary) for _ in range(90)]
        texts.append(template[:105] + own + template[105:])
        if i % 3 == 0:
            copy = list(texts[-1])
            for at in range(105, 195, 2):
                copy[at] = rng.choice(vocabulary)
            planted.append((len(texts) - 1, len(texts)))
            texts.append(copy)
    return texts, planted


def test_pairs_under_a_template_are_found(spark, monkeypatch):
    """Every pair that shares a sketch is compared, also where all leaders are too far from both."""
    texts, planted = template_family(random.Random(8))
    hasher, seed = neardup.Hasher(), neardup.seeds(neardup.SKETCHES)
    sketches = [set(neardup.text_buckets(hasher(ws), seed).tolist()) for ws in texts]
    linked = {(a, b) for a, b in itertools.combinations(range(len(texts)), 2)
              if sketches[a] & sketches[b] and neardup.edit_similarity(texts[a], texts[b]) is not None}
    assert linked == set(planted)
    docs = documents(spark, [(i, " ".join(ws), "en") for i, ws in enumerate(texts)])
    want = list(range(len(texts)))
    for a, b in planted:
        want[b] = a
    for most in (neardup.GROUP, 7):  # whole buckets, and buckets in several blocks
        monkeypatch.setattr(neardup.linked_nodes, "__defaults__", (*neardup.linked_nodes.__defaults__[:-1], most))
        got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
        assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("n", [6, 10, 20, 40, 127, 130, 300])
def test_recall_of_sketches(n):
    """Random texts with scattered replaced words, similarity 0.8 (the least that counts): at least nine in ten pairs share a bucket."""
    rng = random.Random(n)
    hasher, seed = neardup.Hasher(), neardup.seeds(neardup.SKETCHES)
    of = lambda ws: set(neardup.text_buckets(hasher(ws), seed).tolist())
    found = 0
    for _ in range(400):
        a = [f"w{rng.randrange(5000)}" for _ in range(n)]
        b = list(a)
        for at in rng.sample(range(n), n // 5):
            b[at] = f"v{rng.randrange(5000)}"
        assert neardup.edit_similarity(a, b) is not None
        found += bool(of(a) & of(b))
    print(n, found / 400)
    assert found >= 360


@pytest.mark.parametrize("most", [1024, 16, 5])
def test_groups_lose_no_link(spark, most):
    """Without sketches: texts in buckets of every size, some in one class already; links join what brute force joins."""
    rng = random.Random(11)
    rows = []
    for i in range(60):
        a = [rng.choice("abcdefghijklmnopqrst") * rng.randint(1, 3) for _ in range(rng.randint(1, 80))]
        b = [w if rng.random() > 0.17 else "new" for w in a]
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    words = {i: neardup.words_of(t) for i, t in rows}
    texts = spark.createDataFrame(rows, "node long, text string")
    cls = {i: i if i % 5 else 0 for i in words}  # a fifth is one class
    held = [(b, i) for i in words for b in ({1} | {100 + i // 40} | ({7} if i % 3 else set()))]
    members = spark.createDataFrame([(b, i, len(words[i]), cls[i]) for b, i in held], "bucket long, node long, n_words int, cls long")
    links = [(r.a, r.b) for r in neardup.remaining_links(members, texts, neardup.bags(texts), 0.8, most).collect()]
    near = [p for p in itertools.combinations(sorted(words), 2) if neardup.edit_similarity(words[p[0]], words[p[1]]) is not None]
    assert len(near) >= 20 and {tuple(sorted(p)) for p in links} <= set(near)

    def joined(pairs):
        up = dict(cls)

        def root(i):
            while up[i] != i:
                i = up[i]
            return i

        for a, b in pairs:
            up[max(root(cls[a]), root(cls[b]))] = min(root(cls[a]), root(cls[b]))
        return {i: root(cls[i]) for i in words}

    assert joined(links) == joined(near)
    # what is in one class already is not compared
    assert all(cls[a] != cls[b] for a, b in links)


def test_a_family_meets_in_one_bucket(spark, monkeypatch):
    """Forty texts that share thirty buckets bring a row each to the groups, not one for every bucket."""
    rows = []
    for i in range(20):
        own = [f"w{i}x{j}" for j in range(50)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[:-5]))]
    texts = spark.createDataFrame(rows, "node long, text string")
    held = [(b, n, 50 - 5 * (n % 2), n if n > 9 else 0) for b in range(30) for n in range(40)]
    members = spark.createDataFrame(held, "bucket long, node long, n_words int, cls long")
    made, was = collections.Counter(), neardup.written

    def written(df, label):
        out = was(df, label)
        made[label] += out.count()
        return out

    monkeypatch.setattr(neardup, "written", written)
    links = neardup.remaining_links(members, texts, neardup.bags(texts), 0.8).collect()
    assert sorted((r.a, r.b) for r in links) == [(n, n + 1) for n in range(10, 40, 2)]  # the first ten are one class
    assert made["groups"] == 40


def test_members_stay_where_they_own_a_pair(spark):
    """Of a pair with several common buckets both members stay in the first one; members without a pair there leave some."""
    rng = random.Random(12)
    held = set()
    for n in range(120):
        family = n % 6
        held |= {(10 * family + b, n) for b in range(10) if rng.random() < ((b == 0 and family < 5) or 0.4)}
        if n % 40 < 2:
            held |= {(rng.randrange(60), n)}
    held = sorted(held)
    cls = {n: n % 6 if n % 6 < 4 and n % 9 else 1000 + n for n in range(120)}
    of = collections.defaultdict(set)
    for b, n in held:
        of[n].add(b)
    members = spark.createDataFrame([(b, n, 9, cls[n], min(of[n])) for b, n in held], "bucket long, node long, n_words int, cls long, first long")
    kept = {(r.bucket, r.node) for r in neardup.owning(members).collect()}
    for x, y in itertools.combinations(range(120), 2):
        if cls[x] != cls[y] and of[x] & of[y]:
            assert {(min(of[x] & of[y]), x), (min(of[x] & of[y]), y)} <= kept
    assert kept <= set(held) and len(kept) < 0.8 * len(held)



def test_a_round_has_a_pair_for_each_member_at_most(spark):
    # forty near copies that share many buckets with different leaders
    rows = [(b, n, 100, n) for b in range(30) for n in range(40) if (n * 7 + b * 11) % 5]
    rest = spark.createDataFrame(rows, "bucket bigint, node bigint, n_words int, cls bigint")
    leaders = set()
    for turn in range(2):
        pairs = [(r.a, r.na, r.b, r.nb) for r in neardup.led_pairs(rest, 0.8, turn).collect()]
        assert len({b for _, _, b, _ in pairs}) == len(pairs) >= 39
        assert all(a != b and na == nb == 100 for a, na, b, nb in pairs)
        leaders.add(frozenset(p[0] for p in pairs))
    assert len(leaders) == 2


def test_texts_without_neighbours_move_once(spark, monkeypatch):
    rng = random.Random(12)
    texts = [" ".join(f"w{i}x{rng.randrange(10 ** 6)}" for _ in range(60)) for i in range(40)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(100 + i, texts[i] + " end", "en") for i in range(4)]
    seen = []
    for name, of in (("verify", neardup.verify), ("remaining_links", neardup.remaining_links)):
        monkeypatch.setattr(neardup, name, lambda x, texts, *a, of=of: seen.append({r.text for r in texts.collect()}) or of(x, texts, *a))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: i % 100 for i, _, _ in rows}
    paired = set(texts[:4]) | {t + " end" for t in texts[:4]}
    assert len(seen) >= 2 and all(x == paired for x in seen)


@pytest.mark.parametrize("setting", [None, "false"])
def test_shuffle_files_go_with_the_write(spark, setting):
    from pyspark.sql import functions as F

    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(held.size()) if (name := held.apply(i).getName()).startswith("shuffle_")}

    before = files()
    if setting:
        spark.conf.set(common.CLEANUP, setting)
    try:
        df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
        back = common.written(df, "test")
        until = time.time() + 20
        while files() - before and time.time() < until:
            time.sleep(0.1)
        assert not files() - before  # though df, and with it the plan, is still held
        assert spark.conf.get(common.CLEANUP, None) == setting
        assert sorted(back.collect()) == sorted(df.collect()) and back.count() == 10
    finally:
        spark.conf.unset(common.CLEANUP)


def test_bags_rule_out_no_link(spark):
    rng = random.Random(9)
    rows = []
    for i in range(200):
        a = [rng.choice("abcdefghij") * rng.randint(1, 40) for _ in range(rng.randint(1, 600))]
        b = [w for w in a if rng.random() > 0.1] or a
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b[:-1] + ["z"]))]
    texts = spark.createDataFrame(rows, "node long, text string")
    words = {i: neardup.words_of(t) for i, t in rows}
    every = {(2 * i, j) for i in range(200) for j in (2 * i + 1, (2 * i + 3) % 400)}
    pairs = spark.createDataFrame([(a, len(words[a]), b, len(words[b])) for a, b in every], "a long, na long, b long, nb long")
    kept = {(r.a, r.b) for r in neardup.plausible(pairs, neardup.bags(texts), 0.8).collect()}
    near = {p for p in every if neardup.edit_similarity(words[p[0]], words[p[1]]) is not None}
    assert near <= kept < every
    assert {(r.a, r.b) for r in neardup.verify(pairs, texts, 0.8).collect()} == near


def test_near_duplicate_edges(spark):
    docs = documents(spark, EDGE)
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == len(EDGE)
    by = collections.defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.class_id)
    assert by[1] == by[2] == {1} and by[4] == {4} and by[None] == {None}
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    clash = docs.withColumn("_n", docs.doc_id).withColumn("class_id", docs.text)
    assert neardup.keep_one(clash).columns == clash.columns and neardup.keep_one(clash).count() == kept.count()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (False, 4), (False, 5), (True, 0)]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0 and neardup.keep_one(docs.limit(0)).count() == 0


# ---- neighbours ----

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")


def brute(rows, query, k):
    q = dict(rows)[query]
    far = sorted((float(np.sqrt(((np.array(v, float) - np.array(q, float)) ** 2).sum())), i) for i, v in rows if i != query and len(v) == len(q))
    return [i for _, i in far[:k]]


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = collections.defaultdict(list)
    for r in queries.op9_nearest_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    hit = 0
    for q, found in got.items():
        assert [r["rank"] for r in found] == list(range(1, len(found) + 1))
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        hit += len({r.vec_id for r in found} & set(brute(rows, q, 10)))
    assert len(got) == sum(i % 100 == 0 for i, _ in rows) and hit >= 0.9 * 10 * len(got)


def test_blocks_merge(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).astype("float32").tolist()) for i in range(600)]
    frame = vectors(spark, rows)
    got = collections.defaultdict(list)
    for r in ann.search(frame, frame.filter("vec_id % 100 = 0"), block_rows=100, least=100_000).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert {q: brute(rows, q, 10) for q in got} == got and len(got) == 6


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0, 0.5]),
            (8, [1.0, 0.5]), (9, [1.0, 0.0, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 0.5]), (10, [-1.0, 0.0])]
    frame = vectors(spark, rows)
    got = ann.search(frame, frame.filter("vec_id % 100 = 0")).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 7), (2, 8), (3, 10)]
    assert ann.search(frame.limit(0), frame.limit(0)).count() == 0
    same = vectors(spark, [(i, [1.0, 2.0]) for i in range(300)])  # one vector: ties go to the smallest ids
    got = ann.search(same, same.filter("vec_id = 100")).collect()
    assert sorted(r.vec_id for r in got) == list(range(10)) and {r.score for r in got} == {0.0}


def test_every_vector_of_a_repeated_id_is_a_candidate(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(size=4)]) for i in rng.integers(0, 40, 400)] + [(100, [0.1, 0.2, 0.3, 0.4])]
    frame = spark.createDataFrame(rows + rows[:50], "vec_id long, embedding array<float>")
    nearest = {}
    ask = np.float32([0.1, 0.2, 0.3, 0.4]).astype(np.float64)
    for i, v in rows:
        if i != 100:
            d = float(np.sqrt(((np.float32(v).astype(np.float64) - ask) ** 2).sum()))
            nearest[i] = min(d, nearest.get(i, d))
    want = sorted((d, i) for i, d in nearest.items())[:10]
    for size in (50, 100_000):
        got = ann.search(frame, frame.filter("vec_id = 100"), block_rows=size, least=100_000).orderBy("rank").collect()
        assert [r.vec_id for r in got] == [i for _, i in want]
        assert [r.score for r in got] == pytest.approx([d for d, _ in want])


def test_numerals_are_no_letters(spark):
    assert langid.WORD.findall("½ ² Ⅻ 12 a_b m² ß 你好 é") == ["a", "b", "m", "ß", "你好", "é"]
    rng = random.Random(5)
    for _ in range(300):  # the quick way finds what the exact class finds, at the same places
        text = "".join(rng.choice(["a", "é", "ß", "你", "²", "½", "Ⅻ", "7", "٣", "_", " ", "-", "\U00010107", "\U0001d7d8", "𝒜", "\u0301"]) for _ in range(rng.randint(0, 30)))
        want = [(x.span(), x[0]) for x in langid.WORD.exact.finditer(text)]
        assert [(x.span(), x[0]) for x in langid.WORD.finditer(text)] == want
        assert langid.WORD.findall(text) == [w for _, w in want]



# ---- WARC ----

def test_loser_tree_merges():
    rng = random.Random(9)
    for _ in range(200):
        runs = [sorted(rng.randint(0, 30) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 9))]
        assert list(warc.LoserTree(runs, key=lambda x: x)) == sorted(x for r in runs for x in r)


def test_records_round_trip():
    payload = "é <html>\r\n\r\nWARC/1.1\r\n".encode() * 9
    digest = hashlib.sha256(payload).hexdigest()
    raw = warc.record(7, "http://a/b\r\nX: y", payload, digest, 5, None) + warc.record(9, None, payload, digest, 6, 7)
    (h1, b1), (h2, b2) = warc.read_records(io.BytesIO(raw))
    assert warc.capture(h1, b1) == (7, len(payload), digest, "response", None)
    assert warc.capture(h2, b2) == (9, len(payload), digest, "revisit", 7)
    assert "x" not in h1 and h1["warc-target-uri"] == "http://a/b%0D%0AX:%20y"
    with pytest.raises(ValueError):
        warc.capture(h1, b1[:-1])


def test_warc_query_against_sql(spark):
    for sf in (SF_SMALL, SF):
        res = compare(queries.op10_warc(spark, sf), duck(sf), queries.ORACLE["op10_warc"])
        assert res["ok"], res


def test_archives_and_index(spark, tmp_path):
    rows = [(i, f"http://h{i % 3}.example.org/p?q={i % 5}", f"page {i % 7} " * 20, "x") for i in range(60)]
    rows += [(3, "http://h0.example.org/p?q=3", "page 3 " * 20, "x"), (None, None, None, "x"), (70, None, "", "x"), (71, "short", "short", "x"),
             (72, "short", "short", "x"), (73, "http://big/", "y" * 3_000_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, position string").repartition(5)
    index, captures = warc.archive_pages(pages, folder=str(tmp_path), archive_bytes=2000)
    entries = index.orderBy("position").collect()
    assert [e.position for e in entries] == list(range(len(rows)))
    keys = [warc.order_key((e.url_key, e.ts, e.id)) for e in entries]
    assert keys == sorted(keys)
    for e in entries:  # every entry finds its record
        with open(e.archive, "rb") as f:
            f.seek(e.at)
            member = gzip.decompress(f.read(e.size))
        (headers, block), = warc.read_records(io.BytesIO(member))
        assert warc.capture(headers, block)[0] == e.id
    got = captures.collect()
    assert len(got) == len(rows) and len(os.listdir(tmp_path)) > 5
    first = {}
    for i, _, h, _ in rows:
        if i is not None and len(h) >= 100:
            first[h] = min(first.get(h, i), i)
    want = collections.Counter()
    for i, _, h, _ in rows:
        keep = first.get(h) if i is not None else None
        again = keep is not None and i > keep
        want[i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if again else "response", keep if again else None] += 1
    assert collections.Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    index, captures = warc.archive_pages(pages.limit(0), folder=str(tmp_path / "none"))
    assert index.count() == 0 and captures.count() == 0


# ---- pipeline ----

def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    left = {}
    at = docs
    for name, stage in P.STAGES[:-1]:
        at = stage(spark, at, SF_SMALL).cache()
        assert at.columns == docs.columns
        left[name] = {r.doc_id: r for r in at.collect()}
    total = docs.count()
    assert total >= len(left["language_id"]) >= len(left["quality_rules"]) > len(left["near_dedup"]) == len(left["redact_secrets"]) > 0
    assert len(left["language_id"]) >= 0.98 * total
    scan = secrets.Scanner().scan
    for r in left["redact_secrets"].values():
        before = left["near_dedup"][r.doc_id]
        assert not scan(r.text) and r.n_chars == len(r.text)
        assert scan(before.text) or r.text == before.text
    pieces = P.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} == set(left["redact_secrets"])
    assert max(r.sequence_id for r in pieces) + 1 == -(-sum(r.length for r in pieces) // 1024)


def test_pipeline_edges(spark):
    import corpus_pipeline as P

    docs = spark.createDataFrame([(i, t, y, "s", None) for i, t, y in EDGE],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        at = frame
        for _, stage in P.STAGES:
            out = stage(spark, frame, SF_SMALL)
            out.collect()
            at = stage(spark, at, SF_SMALL)
        at.collect()


def test_queries_of_a_block_dealt_over_tasks(spark, monkeypatch):
    rng = np.random.default_rng(12)
    frame = vectors(spark, [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(2000, 8)))])
    frame = spark.createDataFrame(frame.collect(), frame.schema)
    asked = frame.filter("vec_id % 4 = 0")
    found = {}
    for least, blocks in ((10_000, 2_000), (50, 2_000), (50, 1_000)):  # one task, a block in several, blocks in several
        monkeypatch.setattr(ann, "TASK_QUERIES", least)
        found[least, blocks] = {tuple(r) for r in ann.search(frame, asked, k=3, share=16.0, block_rows=blocks).collect()}
    whole = found.pop((10_000, 2_000))
    assert len(whole) == 1500 and all(f == whole for f in found.values())  # with that share every row is a candidate


def test_index_merged_in_many_ranges(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://h{i % 3}.org/p{i % 7}" if i % 11 else None, f"<p>{'word ' * 30}{i % 50}</p>") for i in range(400)] + [(5, "http://a.org/", None)] * 9
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    monkeypatch.setattr(warc, "RANGE_ENTRIES", 30)
    index, captures = warc.archive_pages(pages, folder=str(tmp_path), archive_bytes=3000)
    entries = index.orderBy("position").collect()
    assert [e.position for e in entries] == list(range(409)) and captures.count() == 409
    keys = [warc.order_key((e.url_key, e.ts, e.id)) for e in entries]
    assert keys == sorted(keys) and len({(e.archive, e["at"]) for e in entries}) == 409
    assert collections.Counter(e.id for e in entries) == collections.Counter(r[0] for r in rows)
