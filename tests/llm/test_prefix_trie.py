"""Prefix trie against a dictionary of prefixes, over blocks of every size and on edge rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from conftest import SF_SMALL
from oracle_harness import compare, duck
from ruleweave.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, parent_conv_id string, n int"


def brute(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).hexdigest(), x or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in turns.items()}
    full = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - c % 100, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        own_saved = (len(who) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own_saved
            leaves[node[:d]] += not kids.get(node)
    return sorted((w[0], len(p), members[p[:-1]][0] if p else None, len(w), len(kids.get(p, ())), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in w if len(full[c]) == len(p)).encode()).hexdigest())
                  for p, w in members.items())


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, prefix_trie.prefix_trie(df, **options).collect()), key=lambda r: (r[0], r[1]))


def talk(rng, n_convs, longest=7):
    rows = []
    for c in rng.sample(range(0, 300), n_convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if rng.random() < .3 else "user", rng.choice(["a", "bb", "", "é"])))
    return rows


@pytest.mark.parametrize("seed,block", [(1, 3), (2, 8), (3, 40), (4, 1 << 15)])
def test_random_conversations(spark, seed, block):
    rows = talk(random.Random(seed), 60)
    assert found(spark, rows, block_turns=block) == sorted(brute(rows), key=lambda r: (r[0], r[1]))


def test_copies_over_many_blocks(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 4000, 100) for t in range(4)]
    rows += [(c, 0, "user", "turn 0") for c in range(50, 4050, 100)]
    assert found(spark, rows, block_turns=7) == sorted(brute(rows), key=lambda r: (r[0], r[1]))


def test_edge_rows(spark):
    rows = [(None, 0, "user", "nobody's"), (3, None, None, None), (3, 1, "user", None), (3, 1, "user", None), (103, 5, "", "x" * 100_000),
            (200, 0, "user", "long " * 30_000), (205, 0, "a", "b"), (206, 0, "1:a", "b"), (-7, 0, "user", "minus"), (900, 1, None, "")]
    rows += [(17, t, "user", str(t % 3)) for t in range(600)]
    for block in (2, 1000):
        assert found(spark, rows, block_turns=block) == sorted(brute(rows), key=lambda r: (r[0], r[1]))
    assert found(spark, []) == []


def test_turnless(spark):
    # every conversation is dropped by its own head and has no first one of its hundred
    ids = [c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 2]
    rows = [(c, 0, "user", "gone") for c in ids]
    got = found(spark, rows, block_turns=10)
    assert got == brute(rows) and len(got) == 1 and got[0][5] == 1


def test_query_against_sql(spark):
    got = compare(queries.op11_prefix_trie(spark, SF_SMALL), duck(SF_SMALL), queries.ORACLE["op11_prefix_trie"])
    assert got["ok"], got
