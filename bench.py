"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with the ``noop`` sink (full computation, nothing sent to
the driver).  One warm-up pass, then the median of ``BENCH_RUNS`` runs per
query.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ruleweave.plans import catalog as C  # noqa: E402
from ruleweave.session import ensure_checkpoint_dir, local_session  # noqa: E402

HEADLINE = [
    "rules_mine",          # rule enumeration + scoring over orders ⋈ customer ⋈ nation
    "rules_topk",          # + top-10 selection
    "rules_cover_pos",     # + cover counters
    "taxo_closure",        # taxonomy closure (fixpoint)
    "nt_parse",            # N-Triples parse
    "subject_counts",      # triple statistics
    "graph_supply_components",  # connected components, supplier -> part
    "graph_supply_pagerank",    # PageRank (20 iterations), supplier -> part
    "tfidf_terms",         # term TF-IDF over documents
]


def run(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    C.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, app="ruleweave-bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    ensure_checkpoint_dir(spark)
    for n in names:  # warm-up (JIT, file listing caches)
        run(spark, n, sf_dir)
    out = {}
    for n in names:
        out[n] = round(statistics.median(run(spark, n, sf_dir) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
