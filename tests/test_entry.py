import importlib.util
import os

import pytest

from conftest import ROOT, SF_SMALL
from oracle_harness import compare, duck

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns[:3] == ["c0", "c1", "c2"] and "wracc" in df.columns and "rank" in df.columns


def catalog_queries():
    from ruleweave.plans.catalog import QUERIES

    return QUERIES


def test_registry_consistent():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 48
    missing = {k for k in set(q) - set(o) if k in catalog_queries()}
    assert missing == {"lr_predict"}


@pytest.mark.parametrize("name", ["rules_topk", "rules_cover_pos", "top_concepts", "taxo_closure", "nt_parse",
                                  "graph_components", "graph_pagerank", "tfidf_terms", "set_except", "nt_count",
                                  "rules_cover_all", "graph_order_line_vertices", "distinct_values", "top_typed_subjects",
                                  "graph_pagerank_tol", "lr_optimum", "tfidf_hashed", "taxo_intervals", "taxo_descendants", "taxo_edges_files", "nt_count_files", "tsv_rows",
                                  "count_vectors", "set_intersect", "rules_mine_full", "rules_mine_mapped_top"])
def test_oracle_small(spark, name):
    con = duck(SF_SMALL)
    df = entry_mod.queries()[name](spark, SF_SMALL)
    res = compare(df, con, entry_mod.oracle_sql()[name])
    assert res["ok"] and res["spark_rows"], res
