"""Fingerprints against a plain computation, their accuracy, and edge rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from ruleweave.llm import fingerprints as fp
from ruleweave.llm import queries

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, k string, fp int, head string"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def word_hash(w):
    return xxhash.xxh64_intdigest(w.encode(), 42)


def run_hash(hs):
    seed = 42
    for h in hs:
        seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
    return seed


def shingles(text):
    ws = [word_hash(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    return {run_hash(ws[i:i + 5]) for i in range(max(len(ws) - 4, min(len(ws), 1)))}


def print_of(text, bins=256, bits=4):
    found = shingles(text)
    if not found:
        return None
    least = [None] * bins
    for h in map(signed, found):
        b = (h >> (64 - bins.bit_length() + 1)) + bins // 2
        least[b] = h if least[b] is None else min(least[b], h)
    first, step = fp.probe_order(bins)
    out = []
    for i in range(bins):
        j = i
        a = 0
        while least[j] is None:
            j = (int(first[i]) + int(step[i]) * a) % bins
            a += 1
        out.append(least[j] & ((1 << bits) - 1))
    return out


def hexed(cells):
    return "" if cells is None else "".join(f"{c:x}" for c in cells)


def like(a, b):
    if a is None or b is None:
        return float(a is b)
    same = sum(x == y for x, y in zip(a, b)) / len(a)
    return max(0.0, (same - 1 / 16) / (1 - 1 / 16))


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for at, (i, text) in enumerate(rows):
        nxt = rows[(at + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[:len(text) - q] + nxt[:q]
        a, b, c = print_of(text), print_of(edited), print_of(nxt)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(a), hexed(b), like(a, b), like(a, c)))
    return out


def check(spark, rows):
    got = [tuple(r) for r in fp.fingerprints(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)).collect()]
    want = brute(rows)
    key = lambda r: tuple((x is not None, x) for x in r)
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], abs=1e-12)


def test_random_texts(spark):
    rng = random.Random(1)
    vocabulary = [f"wörd{i}" for i in range(400)]
    rows = [(rng.randrange(-50, 1000), " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 5, 6, 9, 40, 300, 1500])))) for _ in range(60)]
    check(spark, rows)


def test_edge_rows(spark):
    rows = [(None, "no id at all"), (None, "another without an id"), (7, None), (8, ""), (9, " \t\n "), (10, "a"), (10, "a"), (10, "a"),
            (10, "b"), (11, "\x0b a  b\r\nc d e f "), (12, "long " * 30_000), (13, "z" * 100_000), (14, "  kept as a word \U0001f600" * 5),
            (-3, "minus"), (2 ** 62, "large")]
    check(spark, rows)
    check(spark, [(5, "one row is followed by itself, whatever it holds")])
    assert fp.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_empty_bin_is_filled_in_its_own_order(spark):
    first, step = fp.probe_order(256)
    assert all(len({(int(f) + int(s) * a) % 256 for a in range(256)}) == 256 for f, s in zip(first, step))


def test_copies_of_a_third_of_all_rows(spark):
    rows = [(4, "the same row again and again and again")] * 6000 + [(i, f"text {i} of some five words") for i in range(20)]
    got = fp.fingerprints(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    copies = [r for r in got if r.doc_id == 4]
    assert len(copies) == 6001 and sum(r.near_next == 1.0 for r in copies) >= 5999


def test_likeness_follows_the_share_of_common_shingles(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([30, 120, 700]))]
        rows.append((2 * i, " ".join(words)))
        keep = rng.random()
        rows.append((2 * i + 1, " ".join(words[:int(len(words) * keep)] + [f"v{rng.randrange(10 ** 6)}" for _ in range(20)])))
    texts = dict(rows)
    got = {r.doc_id: r.near_next for r in fp.fingerprints(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)).collect()}
    errors = []
    for i in range(0, 400, 2):
        a, b = shingles(texts[i]), shingles(texts[i + 1])
        errors.append(got[i] - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.045


def test_query_is_native_and_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op12_fingerprints(spark, SF)
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    rows = got.collect()
    assert len(rows) == docs.count()
    want = {r[0]: r for r in brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])}
    for r in rows:
        assert tuple(r)[:5] == want[r.doc_id][:5] and tuple(r)[5:] == pytest.approx(want[r.doc_id][5:], abs=1e-12)
