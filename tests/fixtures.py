"""Small hand-made taxonomies and facts for unit tests, plus a brute-force
model of the general-to-specific rule search used as the test oracle."""

from __future__ import annotations

import itertools
import random
from collections import defaultdict

TOP = "Thing"
# own taxonomies: (k, child, parent)
EDGES = [
    (0, "Work", TOP), (0, "Idle", TOP), (0, "Office", "Work"), (0, "Field", "Work"),
    (0, "Clerk", "Office"), (0, "Manager", "Office"), (0, "Farmer", "Field"), (0, "Miner", "Field"),
    (0, "Student", "Idle"), (0, "Retired", "Idle"),
    (1, "North", TOP), (1, "South", TOP), (1, "Oslo", "North"), (1, "Bergen", "North"),
    (1, "Rome", "South"), (1, "Naples", "South"), (1, "Trastevere", "Rome"),
    (2, "Saving", TOP), (2, "Credit", TOP), (2, "Deposit", "Saving"), (2, "Bond", "Saving"),
    (2, "Mortgage", "Credit"), (2, "CarLoan", "Credit"),
]
MAPPING = {0: ["job"], 1: ["city"], 2: ["p1", "p2"]}
JOBS = ["Clerk", "Manager", "Farmer", "Miner", "Student", "Retired", "Office", "Nobody", None]
CITIES = ["Oslo", "Bergen", "Trastevere", "Naples", "South", "Atlantis", None]
PRODUCTS = ["Deposit", "Bond", "Mortgage", "CarLoan", "No", None]


def make_facts(n: int = 60, seed: int = 7) -> list[tuple]:
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((i, rnd.choice(JOBS), rnd.choice(CITIES), rnd.choice(PRODUCTS), rnd.choice(PRODUCTS),
                     rnd.random() < 0.5))
    return rows


FACT_DDL = "id long, job string, city string, p1 string, p2 string, target boolean"


def brute_force_rules(facts, edges, mapping, *, min_pos, top_matches_all=True, expand_last=False, max_terms=3):
    """Every prefix of one concept per ontology, counted by sets of record ids.

    Returns ``{(c0, c1, c2): (cov, pos)}`` of the rules with more than ``min_pos``
    positives, a function from a rule to its records, the positives and all ids.
    """
    cols = ["id", "job", "city", "p1", "p2", "target"]
    records = [dict(zip(cols, r)) for r in facts]
    every = {r["id"] for r in records}
    positive = {r["id"] for r in records if r["target"]}
    up = defaultdict(set)
    for k, child, parent in edges:
        up[k, child].add(parent)

    def lineage(k, value):
        seen, todo = set(), [value]
        while todo:
            c = todo.pop()
            if c not in seen:
                seen.add(c)
                todo += up[k, c]
        return seen if TOP in seen else set()

    covers = {k: defaultdict(set) for k in mapping}
    for r in records:
        for k, columns in mapping.items():
            for column in columns:
                for concept in lineage(k, r[column]):
                    covers[k][concept].add(r["id"])
    if top_matches_all:
        for k in mapping:
            covers[k][TOP] = set(every)

    def rows_rule(rule):
        return set.intersection(every, *(covers[k][c] for k, c in rule.items()))

    last = len(mapping) - 1
    choices = {k: [TOP] if k == last and not expand_last else sorted(covers[k]) for k in mapping}
    found = {}
    for size in range(1, min(max_terms, len(mapping)) + 1):
        for terms in itertools.product(*(choices[k] for k in range(size))):
            rows = rows_rule(dict(enumerate(terms)))
            if len(rows & positive) > min_pos:
                found[terms + (None,) * (min(max_terms, len(mapping)) - size)] = (len(rows), len(rows & positive))
    return found, rows_rule, positive, every


def simulate_counters(rule_rows, selected, population_ids, start, floor):
    """Sequential decrement loop: each selected rule lowers the counter of the
    rows it covers among the remaining ones; rows below ``floor`` leave."""
    counters = {i: start for i in population_ids}
    for rule in selected:
        covered = rule_rows(rule) & set(counters)
        if not covered:
            continue
        for i in covered:
            counters[i] -= 1
        counters = {i: c for i, c in counters.items() if c >= floor}
    return counters
