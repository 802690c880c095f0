"""Query catalogue: each entry takes ``(spark, sf_dir)`` and returns a DataFrame.

Keys match ``plans.oracle`` (DuckDB SQL over the same parquet tables).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.functions.numeric import grid_round
from ruleweave.operators import graph as G
from ruleweave.operators import hierarchy as H
from ruleweave.operators import intervals as I
from ruleweave.operators import rules as R
from ruleweave.operators import sets as S
from ruleweave.operators import text as X
from ruleweave.operators import triples as T
from ruleweave.operators.sizing import cut_lineage
from ruleweave.plans import bindings as B
from ruleweave.plans.mining import Mining
from ruleweave.sources.ntriples import parse_ntriples, read_lines, read_taxonomy_files
from ruleweave.sources.tables import read_with_rejects

Query = Callable[[SparkSession, str], DataFrame]

# Mining settings (fixed): the first miner, its full search, and the second miner.
FIRST = R.MiningSpec(mapping=B.FACT_MAPPING, top=B.TOP, min_pos=4)
FIRST_FULL = R.MiningSpec(mapping=B.FACT_MAPPING, top=B.TOP, min_pos=4, expand_last=True)
SECOND = R.MiningSpec(mapping=B.FACT_MAPPING, top=B.TOP, min_pos=8, top_matches_all=False)
TOP_K = 10
# concept / rule used by the row-selection queries
CONCEPT_K, CONCEPT = 0, "EUROPE"
RULE_TERMS = {0: "EUROPE", 1: "Industrial"}


def taxonomy_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed triples of every ontology, ``k`` = ontology id."""
    parts = [parse_ntriples(lines).withColumn("k", F.lit(i))
             for i, lines in enumerate(B.taxonomy_lines(spark, sf_dir))]
    return reduce(DataFrame.unionByName, parts)


def taxonomy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.subclass_edges(taxonomy_triples(spark, sf_dir))


def _mining(spark: SparkSession, sf_dir: str, spec: R.MiningSpec) -> Mining:
    return Mining(B.facts(spark, sf_dir), taxonomy_edges(spark, sf_dir), spec)


def q_rules_mine(spark, sf_dir):
    return _mining(spark, sf_dir, FIRST).rules


def q_rules_mine_full(spark, sf_dir):
    return _mining(spark, sf_dir, FIRST_FULL).rules


def q_rules_mine_mapped_top(spark, sf_dir):
    return _mining(spark, sf_dir, SECOND).rules


def q_rules_topk(spark, sf_dir):
    return _mining(spark, sf_dir, FIRST).selected(TOP_K)


def q_rules_summary(spark, sf_dir):
    return R.rule_summary(_mining(spark, sf_dir, FIRST).rules)


def q_rules_cover_pos(spark, sf_dir):
    m = _mining(spark, sf_dir, FIRST)
    return m.counters(m.selected(TOP_K), population="positives", start=50, floor=1, bounded=True)


def q_rules_cover_all(spark, sf_dir):
    """All rows, counters 5 with floor 4, over the ten best rules: rows that two or more of them cover leave."""
    m = _mining(spark, sf_dir, SECOND)
    return m.counters(m.selected(TOP_K), population="all", start=5, floor=4, bounded=True)


def q_concept_rows(spark, sf_dir):
    m = _mining(spark, sf_dir, FIRST)
    return R.rule_rows(m.facts, m.edges, FIRST, {CONCEPT_K: CONCEPT}, m.ancestors)


def q_rule_rows(spark, sf_dir):
    m = _mining(spark, sf_dir, FIRST)
    return R.rule_rows(m.facts, m.edges, FIRST, RULE_TERMS, m.ancestors)


def q_top_concepts(spark, sf_dir):
    m = _mining(spark, sf_dir, FIRST)
    return R.top_concepts(m.facts, m.edges, FIRST, m.ancestors)


# --- taxonomy listings -------------------------------------------------------

def q_taxo_edges(spark, sf_dir):
    return taxonomy_edges(spark, sf_dir)


def q_taxo_edges_files(spark, sf_dir):
    """The taxonomies written as text, one folder per ontology, and read back in one scan."""
    paths = [B.as_text_files(lines) for lines in B.taxonomy_lines(spark, sf_dir)]
    return H.subclass_edges(read_taxonomy_files(spark, paths))


def q_nt_count_files(spark, sf_dir):
    """Line kinds of the triples written as text and scanned as raw lines."""
    return T.line_counts(read_lines(spark, B.as_text_files(B.triple_lines(spark, sf_dir))))


def q_tsv_rows(spark, sf_dir):
    """Customers written as tab-separated text and read back: accepted rows, and rejected lines in ``line``."""
    rows, rejects = read_with_rejects(spark, B.as_text_files(B.customer_tsv(spark, sf_dir)), B.TSV_COLUMNS, header=False)
    return rows.withColumn("line", F.lit(None).cast("string")).unionByName(rejects, allowMissingColumns=True)


def q_taxo_concepts(spark, sf_dir):
    return H.concepts(taxonomy_edges(spark, sf_dir))


def q_taxo_children(spark, sf_dir):
    return H.children(taxonomy_edges(spark, sf_dir))


def q_taxo_closure(spark, sf_dir):
    return H.closure(taxonomy_edges(spark, sf_dir))


def q_taxo_descendants(spark, sf_dir):
    """All strict descendants of one concept (the descendant lookup)."""
    return H.descendants(taxonomy_edges(spark, sf_dir), CONCEPT_K, CONCEPT)


def q_taxo_intervals(spark, sf_dir):
    """Interval labels of all concepts; the taxonomies are trees, so no edge is left out."""
    return I.interval_labels(taxonomy_edges(spark, sf_dir))[0]


def q_uri_dictionary(spark, sf_dir):
    return H.uri_dictionary(taxonomy_triples(spark, sf_dir))


# --- N-Triples statistics -----------------------------------------------------

def _triples(spark, sf_dir):
    return parse_ntriples(B.triple_lines(spark, sf_dir))


def q_nt_parse(spark, sf_dir):
    return _triples(spark, sf_dir)


def q_nt_preview(spark, sf_dir):
    return T.preview(_triples(spark, sf_dir), 5)


def q_nt_by_predicate(spark, sf_dir):
    return T.by_predicate(_triples(spark, sf_dir), "#type", object_prefix="http")


def q_nt_count(spark, sf_dir):
    return T.line_counts(B.triple_lines(spark, sf_dir))


def q_subject_counts(spark, sf_dir):
    return T.subject_counts(_triples(spark, sf_dir))


def q_class_counts(spark, sf_dir):
    return T.class_counts(_triples(spark, sf_dir))


def q_top_subjects(spark, sf_dir):
    return T.top_by_count(T.subject_counts(_triples(spark, sf_dir)), "s", 5)


def q_top_typed_subjects(spark, sf_dir):
    return T.top_by_count(T.types_per_subject(_triples(spark, sf_dir)), "s", 5)


# --- graph --------------------------------------------------------------------
SUBGRAPH_ATTR = B.SCHEMA + "inNation"
PAGERANK_ITER = 20
PAGERANK_TOL = 1e-4


def _triple_graph(spark, sf_dir):
    return G.build_graph(_triples(spark, sf_dir))


def _supply_graph(spark, sf_dir):
    return G.build_graph(B.supply_edges(spark, sf_dir))


def q_graph_vertices(spark, sf_dir):
    return _triple_graph(spark, sf_dir)[0]


def q_graph_edges(spark, sf_dir):
    return _triple_graph(spark, sf_dir)[1]


def q_order_line_vertices(spark, sf_dir):
    """Dense ids over the order and line terms, one per order and line item."""
    return G.dictionary_encode(B.order_line_terms(spark, sf_dir))


def q_graph_subgraph(spark, sf_dir):
    return G.subgraph(_triple_graph(spark, sf_dir)[1], SUBGRAPH_ATTR)


def q_graph_degree(spark, sf_dir):
    return G.out_degrees(_triple_graph(spark, sf_dir)[1])


def q_graph_components(spark, sf_dir):
    v, e = _triple_graph(spark, sf_dir)
    return G.connected_components(v, G.subgraph(e, SUBGRAPH_ATTR))


def q_graph_pagerank(spark, sf_dir):
    v, e = _triple_graph(spark, sf_dir)
    ranks = G.pagerank(v, e, max_iter=PAGERANK_ITER)
    return ranks.join(v, "id").select("id", "label", grid_round("rank").alias("rank"))


def q_graph_pagerank_top(spark, sf_dir):
    v, e = _triple_graph(spark, sf_dir)
    return G.ranked_vertices(G.pagerank(v, e, max_iter=PAGERANK_ITER), v, k=5)


def q_graph_pagerank_tol(spark, sf_dir):
    v, e = _triple_graph(spark, sf_dir)
    ranks = G.pagerank(v, e, max_iter=1000, tol=PAGERANK_TOL, normalize=True)
    return ranks.join(v, "id").select("id", "label", grid_round("rank").alias("rank"))


def q_graph_supply_components(spark, sf_dir):
    v, e = _supply_graph(spark, sf_dir)
    return G.connected_components(v, e)


def q_graph_supply_pagerank(spark, sf_dir):
    v, e = _supply_graph(spark, sf_dir)
    ranks = G.pagerank(v, e, max_iter=PAGERANK_ITER)
    return ranks.join(v, "id").select("id", "label", grid_round("rank").alias("rank"))


# --- text ---------------------------------------------------------------------

HASH_BUCKETS = 20


def q_tokens_ws(spark, sf_dir):
    return X.tokenize_whitespace(B.documents(spark, sf_dir)).select("doc_id", "tokens")


def q_tokens_regex(spark, sf_dir):
    return X.tokenize_regex(B.documents(spark, sf_dir)).select("doc_id", "tokens")


def q_token_counts(spark, sf_dir):
    return X.token_counts(B.documents(spark, sf_dir))


def q_tfidf_terms(spark, sf_dir):
    return X.term_tfidf(B.documents(spark, sf_dir))


def q_tfidf_hashed(spark, sf_dir):
    found = X.hashed_tfidf(B.documents(spark, sf_dir), num_features=HASH_BUCKETS)
    return found.select("doc_id", F.transform("features", lambda x: grid_round(x)).alias("features"))


VOCABULARY = 500


def q_count_vectors(spark, sf_dir):
    return X.count_vectors(B.documents(spark, sf_dir), VOCABULARY)


def q_lr_predict(spark, sf_dir):
    docs = B.labeled_documents(spark, sf_dir)
    return X.predict(X.fit_text_classifier(docs), docs)


OPTIMUM_FEATURES = 32


def q_lr_optimum(spark, sf_dir):
    """A converged fit with its certificate: every slope of the loss is zero, and the expected positives are the real ones."""
    docs = B.labeled_documents(spark, sf_dir)
    model = X.fit_text_classifier(docs, num_features=OPTIMUM_FEATURES, max_iter=500, reg_param=0.1, tol=1e-12)
    slopes = cut_lineage(X.loss_gradient(model, docs))
    positives = slopes.filter(F.col("feature") == X.INTERCEPT).select(F.round("expected").cast("long")).scalar()
    return slopes.select("class", "feature", (grid_round("gradient", 10) + 0.0).alias("gradient"), positives.alias("positives"))


# --- set algebra and whole-row joins ---------------------------------------------
SET_CONCEPTS = {"a": {0: "EUROPE"}, "b": {1: "Industrial"}, "c": {2: "Expedited"},
                "d": {0: "AFRICA"}, "e": {0: "AMERICA"}, "f": {1: "Consumer"}}
LIKE_PATTERN = "NATION_1%"


def _rows(m: Mining, name: str) -> DataFrame:
    return R.rule_rows(m.facts, m.edges, m.spec, SET_CONCEPTS[name], m.ancestors)


def _best_rule_rows(m: Mining) -> DataFrame:
    """Rows covered by the best rule (one rule row is brought to the driver)."""
    best = m.selected(1).first()
    terms = {k: best[c] for k, c in enumerate(m.spec.rule_columns()) if best[c] is not None}
    return R.rule_rows(m.facts, m.edges, m.spec, terms, m.ancestors)


def q_set_intersect(spark, sf_dir):
    m = _mining(spark, sf_dir, FIRST)
    return S.intersect_all([_rows(m, "a"), _rows(m, "b"), _rows(m, "c")])


def q_set_union(spark, sf_dir):
    m = _mining(spark, sf_dir, FIRST)
    return S.union_distinct([_rows(m, "d"), _rows(m, "e"), _rows(m, "f")])


def q_set_except(spark, sf_dir):
    m = _mining(spark, sf_dir, FIRST)
    return S.except_distinct(_rows(m, "a"), _rows(m, "b"))


def q_join_all_cols(spark, sf_dir):
    """One decrement step: positives (counter 50) joined on all columns with the
    positive rows of the best rule, counter lowered by one."""
    m = _mining(spark, sf_dir, FIRST)
    pos = m.facts.filter(F.col("target"))
    covered = _best_rule_rows(m).filter(F.col("target"))
    joined = S.join_on_all_columns(pos.withColumn("counter", F.lit(50)), covered)
    return joined.withColumn("counter", F.col("counter") - 1)


def q_cover_missing(spark, sf_dir):
    m = _mining(spark, sf_dir, FIRST)
    return S.uncovered(m.facts.filter(F.col("target")), _best_rule_rows(m), "id")


def q_distinct_values(spark, sf_dir):
    return S.distinct_values(B.facts(spark, sf_dir), FIRST.mapped_columns)


def q_target_filter(spark, sf_dir):
    f = B.facts(spark, sf_dir)
    return f.filter(F.col("target") & F.col("nation").like(LIKE_PATTERN))


def q_project(spark, sf_dir):
    return B.facts(spark, sf_dir).select("id", "nation")


QUERIES: dict[str, Query] = {
    "set_intersect": q_set_intersect,
    "set_union": q_set_union,
    "set_except": q_set_except,
    "join_all_cols": q_join_all_cols,
    "cover_missing": q_cover_missing,
    "distinct_values": q_distinct_values,
    "target_filter": q_target_filter,
    "project": q_project,
    "tokens_ws": q_tokens_ws,
    "tokens_regex": q_tokens_regex,
    "token_counts": q_token_counts,
    "tfidf_terms": q_tfidf_terms,
    "tfidf_hashed": q_tfidf_hashed,
    "count_vectors": q_count_vectors,
    "lr_predict": q_lr_predict,
    "lr_optimum": q_lr_optimum,
    "graph_vertices": q_graph_vertices,
    "graph_edges": q_graph_edges,
    "graph_order_line_vertices": q_order_line_vertices,
    "graph_subgraph": q_graph_subgraph,
    "graph_degree": q_graph_degree,
    "graph_components": q_graph_components,
    "graph_pagerank": q_graph_pagerank,
    "graph_pagerank_top": q_graph_pagerank_top,
    "graph_pagerank_tol": q_graph_pagerank_tol,
    "graph_supply_components": q_graph_supply_components,
    "graph_supply_pagerank": q_graph_supply_pagerank,
    "taxo_edges": q_taxo_edges,
    "taxo_edges_files": q_taxo_edges_files,
    "nt_count_files": q_nt_count_files,
    "tsv_rows": q_tsv_rows,
    "taxo_concepts": q_taxo_concepts,
    "taxo_children": q_taxo_children,
    "taxo_closure": q_taxo_closure,
    "taxo_descendants": q_taxo_descendants,
    "taxo_intervals": q_taxo_intervals,
    "uri_dictionary": q_uri_dictionary,
    "nt_parse": q_nt_parse,
    "nt_preview": q_nt_preview,
    "nt_by_predicate": q_nt_by_predicate,
    "nt_count": q_nt_count,
    "subject_counts": q_subject_counts,
    "class_counts": q_class_counts,
    "top_subjects": q_top_subjects,
    "top_typed_subjects": q_top_typed_subjects,
    "rules_mine": q_rules_mine,
    "rules_mine_full": q_rules_mine_full,
    "rules_mine_mapped_top": q_rules_mine_mapped_top,
    "rules_topk": q_rules_topk,
    "rules_summary": q_rules_summary,
    "rules_cover_pos": q_rules_cover_pos,
    "rules_cover_all": q_rules_cover_all,
    "concept_rows": q_concept_rows,
    "rule_rows": q_rule_rows,
    "top_concepts": q_top_concepts,
}
