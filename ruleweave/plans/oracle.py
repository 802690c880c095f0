"""DuckDB oracle SQL for the query catalogue.

Each string runs on views named after the driver's tables.  Fixed taxonomy
values come from :mod:`ruleweave.plans.bindings`, so both sides use the same
constants.  Column names and types mirror the Spark output.
"""

from __future__ import annotations

from ruleweave.plans import bindings as B

TOP = B.TOP


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values_edges() -> str:
    rows = [f"(1, {_q(c)}, {_q(p)})" for c, p in B.SEGMENT_EDGES]
    rows += [f"(2, {_q(c)}, {_q(p)})" for c, p in B.ORDER_EDGES]
    return ", ".join(rows)


def _price_band_case(col: str) -> str:
    parts = [f"CASE WHEN {col} IS NULL THEN NULL"]
    for bound, label in B.PRICE_BANDS:
        if bound is None:
            parts.append(f"ELSE {_q(label)} END")
        else:
            parts.append(f"WHEN {col} < {bound!r} THEN {_q(label)}")
    return " ".join(parts)


EDGES_CTE = f"""
edges(k, child, parent) AS (
  SELECT 0, '{B.CUSTOMER_PREFIX}' || c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 0, n_name, replace(r_name, ' ', '_') FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 0, replace(r_name, ' ', '_'), {_q(B.GEO_ROOT)} FROM region
  UNION ALL SELECT 0, {_q(B.GEO_ROOT)}, {_q(TOP)}
  UNION ALL SELECT * FROM (VALUES {_values_edges()}) v(k, child, parent)
)"""

CLOSURE_CTE = """
clo(k, anc, leaf, depth) AS (
  SELECT k, parent, child, 1 FROM edges
  UNION SELECT c.k, c.anc, e.child, c.depth + 1 FROM clo c JOIN edges e ON e.k = c.k AND e.parent = c.leaf
),
clo_min AS (SELECT k, anc, leaf, min(depth) AS depth FROM clo GROUP BY k, anc, leaf)"""

FACTS_CTE = f"""
facts AS (
  SELECT o_orderkey AS id, '{B.CUSTOMER_PREFIX}' || c_custkey AS customer, n_name AS nation,
         c_mktsegment AS segment, o_orderpriority AS priority,
         {_price_band_case('o_totalprice')} AS price_band,
         o_orderstatus = {_q(B.TARGET_STATUS)} AS target
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

# ancestors-or-self restricted to concepts under the top concept
ANC_CTE = f"""
concepts AS (SELECT DISTINCT k, child AS concept FROM edges UNION SELECT DISTINCT k, parent FROM edges),
self_clo AS (SELECT k, anc, leaf FROM clo_min UNION SELECT k, concept, concept FROM concepts),
under_top AS (SELECT k, leaf AS concept FROM self_clo WHERE anc = {_q(TOP)}),
anc_self AS (
  SELECT s.k, s.anc, s.leaf FROM self_clo s
  JOIN under_top a ON a.k = s.k AND a.concept = s.anc
  JOIN under_top l ON l.k = s.k AND l.concept = s.leaf
),
m(k, id, val) AS (
  SELECT 0, id, customer FROM facts UNION ALL SELECT 1, id, segment FROM facts
  UNION ALL SELECT 2, id, priority FROM facts UNION ALL SELECT 2, id, price_band FROM facts
)"""


def _item_cte(top_matches_all: bool) -> str:
    extra = f"UNION SELECT t.k, f.id, {_q(TOP)} FROM facts f, (VALUES (0), (1), (2)) t(k)" if top_matches_all else ""
    return f"""
item AS (
  SELECT DISTINCT m.k, m.id, s.anc AS concept FROM m JOIN anc_self s ON s.k = m.k AND s.leaf = m.val
  {extra}
)"""


def _cand_cte(expand_last: bool) -> str:
    last = "" if expand_last else f"AND d.concept = {_q(TOP)}"
    return f"""
cand AS (
  SELECT a.concept AS c0, NULL::VARCHAR AS c1, NULL::VARCHAR AS c2, a.id FROM item a WHERE a.k = 0
  UNION ALL
  SELECT a.concept, b.concept, NULL::VARCHAR, a.id FROM item a JOIN item b ON b.id = a.id AND b.k = 1 WHERE a.k = 0
  UNION ALL
  SELECT a.concept, b.concept, d.concept, a.id FROM item a JOIN item b ON b.id = a.id AND b.k = 1
    JOIN item d ON d.id = a.id AND d.k = 2 WHERE a.k = 0 {last}
)"""


def _rules_cte(min_pos: int, top_matches_all: bool, expand_last: bool) -> str:
    return f"""WITH RECURSIVE {EDGES_CTE.strip()},
{CLOSURE_CTE.strip()},
{FACTS_CTE.strip()},
{ANC_CTE.strip()},
{_item_cte(top_matches_all).strip()},
{_cand_cte(expand_last).strip()},
tot AS (SELECT count(*) AS n_total, count(*) FILTER (WHERE target) AS n_target FROM facts),
agg AS (
  SELECT c0, c1, c2, count(*) AS cov, count(*) FILTER (WHERE f.target) AS pos
  FROM cand JOIN facts f USING (id) GROUP BY c0, c1, c2
  HAVING count(*) FILTER (WHERE f.target) > {min_pos}
),
rules AS (
  SELECT c0, c1, c2, cov, pos, n_total, n_target,
         n_total * pos - cov * n_target AS score,
         (n_total * pos - cov * n_target)::DOUBLE / (n_total * n_total)::DOUBLE AS wracc,
         cov::DOUBLE / n_total::DOUBLE AS cov_ratio,
         pos::DOUBLE / n_target::DOUBLE AS sup
  FROM agg, tot
)"""


FIRST = dict(min_pos=4, top_matches_all=True, expand_last=False)
FIRST_FULL = dict(min_pos=4, top_matches_all=True, expand_last=True)
SECOND = dict(min_pos=8, top_matches_all=False, expand_last=False)
RANK_ORDER = "score DESC, pos DESC, c0 ASC NULLS FIRST, c1 ASC NULLS FIRST, c2 ASC NULLS FIRST"


def _topk(k: int) -> str:
    return f"""topk AS (
  SELECT *, row_number() OVER (ORDER BY {RANK_ORDER}) AS rank FROM rules ORDER BY {RANK_ORDER} LIMIT {k}
)"""


def _cover(selected: str, population: str, start: int, floor: int) -> str:
    pop = "WHERE f.target" if population == "positives" else ""
    return f"""hits AS (
  SELECT c.id, count(*) AS h FROM cand c JOIN {selected} r
    ON c.c0 IS NOT DISTINCT FROM r.c0 AND c.c1 IS NOT DISTINCT FROM r.c1 AND c.c2 IS NOT DISTINCT FROM r.c2
  GROUP BY c.id
)
SELECT * FROM (
  SELECT f.id, f.customer, f.segment, f.priority, f.price_band, ({start} - coalesce(h.h, 0))::INTEGER AS counter
  FROM facts f LEFT JOIN hits h ON h.id = f.id {pop}
) WHERE counter >= {floor}"""


def rules_sql() -> dict[str, str]:
    out = {
        "rules_mine": _rules_cte(**FIRST) + "\nSELECT * FROM rules",
        "rules_mine_full": _rules_cte(**FIRST_FULL) + "\nSELECT * FROM rules",
        "rules_mine_mapped_top": _rules_cte(**SECOND) + "\nSELECT * FROM rules",
        "rules_topk": _rules_cte(**FIRST) + ",\n" + _topk(10) + "\nSELECT * FROM topk",
        "rules_summary": _rules_cte(**FIRST) + """
SELECT count(*) AS n_rules, sum(cov)::BIGINT AS sum_cov, sum(pos)::BIGINT AS sum_pos,
       sum(cov)::DOUBLE / (max(n_total)::DOUBLE * count(*)::DOUBLE) AS avg_cov,
       sum(pos)::DOUBLE / (max(n_target)::DOUBLE * count(*)::DOUBLE) AS avg_sup,
       sum(score)::DOUBLE / (max(n_total)::DOUBLE * max(n_total)::DOUBLE * count(*)::DOUBLE) AS avg_wracc
FROM rules""",
        "rules_cover_pos": _rules_cte(**FIRST) + ",\n" + _topk(10) + ",\n" + _cover("topk", "positives", 50, 1),
        "rules_cover_all": _rules_cte(**SECOND) + ",\n" + _topk(10) + ",\n" + _cover("topk", "all", 5, 4),
    }
    base = f"WITH RECURSIVE {EDGES_CTE.strip()},\n{CLOSURE_CTE.strip()},\n{FACTS_CTE.strip()},\n{ANC_CTE.strip()},\n{_item_cte(True).strip()}"
    out["concept_rows"] = base + """
SELECT f.* FROM facts f WHERE f.id IN (SELECT id FROM item WHERE k = 0 AND concept = 'EUROPE')"""
    out["rule_rows"] = base + """
SELECT f.* FROM facts f WHERE f.id IN (SELECT id FROM item WHERE k = 0 AND concept = 'EUROPE')
  AND f.id IN (SELECT id FROM item WHERE k = 1 AND concept = 'Industrial')"""
    out["top_concepts"] = base + f""",
vals AS (SELECT DISTINCT k, val FROM m WHERE val IS NOT NULL),
nv AS (SELECT k, count(*) AS n FROM vals GROUP BY k),
cov AS (
  SELECT v.k, s.anc AS concept, count(*) AS n FROM vals v JOIN anc_self s ON s.k = v.k AND s.leaf = v.val
  WHERE s.anc <> s.leaf GROUP BY v.k, s.anc
)
SELECT c.k, c.concept FROM cov c JOIN nv ON nv.k = c.k WHERE c.n = nv.n
UNION SELECT k, {_q(TOP)} FROM nv"""
    return out


def all_sql() -> dict[str, str]:
    out = {}
    out.update(rules_sql())
    out.update(triples_sql())
    out.update(taxonomy_sql())
    out.update(graph_sql())
    out.update(text_sql())
    out.update(sets_sql())
    return out


# --- N-Triples statistics ----------------------------------------------------
_RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
_XSD_DECIMAL = "http://www.w3.org/2001/XMLSchema#decimal"
_S = B.SCHEMA
_BASE = B.BASE

TRIPLES_CTE = f"""
triples(s, p, o, s_kind, o_kind, o_lang, o_datatype) AS (
  SELECT '{_BASE}customer/' || c_custkey, '{_RDF_TYPE}', '{_S}Customer', 'iri', 'iri', NULL::VARCHAR, NULL::VARCHAR FROM customer
  UNION ALL SELECT '{_BASE}customer/' || c_custkey, '{_S}name', c_name, 'iri', 'literal', NULL, NULL FROM customer
  UNION ALL SELECT '{_BASE}customer/' || c_custkey, '{_S}inNation', '{_BASE}nation/' || c_nationkey, 'iri', 'iri', NULL, NULL FROM customer
  UNION ALL SELECT '{_BASE}customer/' || c_custkey, '{_S}segment', c_mktsegment, 'iri', 'literal', 'en', NULL FROM customer
  UNION ALL SELECT '{_BASE}customer/' || c_custkey, '{_S}acctbal', CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR), 'iri', 'literal', NULL, '{_XSD_DECIMAL}' FROM customer
  UNION ALL SELECT '{_BASE}nation/' || n_nationkey, '{_RDF_TYPE}', '{_S}Nation', 'iri', 'iri', NULL, NULL FROM nation
  UNION ALL SELECT '{_BASE}nation/' || n_nationkey, '{_S}name', n_name, 'iri', 'literal', NULL, NULL FROM nation
  UNION ALL SELECT '{_BASE}nation/' || n_nationkey, '{_S}inRegion', '{_BASE}region/' || n_regionkey, 'iri', 'iri', NULL, NULL FROM nation
  UNION ALL SELECT '{_BASE}nation/' || n_nationkey, '{_S}comment', 'nation "' || n_name || '" <region ' || n_regionkey || '>', 'iri', 'literal', 'en', NULL FROM nation
  UNION ALL SELECT '{_BASE}region/' || r_regionkey, '{_RDF_TYPE}', '{_S}Region', 'iri', 'iri', NULL, NULL FROM region
  UNION ALL SELECT '{_BASE}region/' || r_regionkey, '{_S}name', r_name, 'iri', 'literal', NULL, NULL FROM region
  UNION ALL SELECT '_:geo' || r_regionkey, '{_S}covers', '{_BASE}region/' || r_regionkey, 'bnode', 'iri', NULL, NULL FROM region
  UNION ALL SELECT '{_BASE}region/' || r_regionkey, '{_S}hasArea', '_:area' || r_regionkey, 'iri', 'bnode', NULL, NULL FROM region
  UNION ALL SELECT '{_BASE}region/' || r_regionkey, '{_RDF_TYPE}', '{_S}Place', 'iri', 'iri', NULL, NULL FROM region
  UNION ALL SELECT '{_BASE}café/' || r_regionkey, '{_S}sign', 'x😀y', 'iri', 'literal', NULL, NULL FROM region
  UNION ALL SELECT '_:é:' || r_regionkey, '{_S}covers', '{_BASE}region/' || r_regionkey, 'bnode', 'iri', NULL, NULL FROM region
)"""


def triples_sql() -> dict[str, str]:
    w = "WITH " + TRIPLES_CTE.strip() + "\n"
    n_cust, n_nat, n_reg = "(SELECT count(*) FROM customer)", "(SELECT count(*) FROM nation)", "(SELECT count(*) FROM region)"
    return {
        "nt_parse": w + "SELECT * FROM triples",
        "nt_preview": w + "SELECT * FROM triples ORDER BY s, p, o, o_lang, o_datatype LIMIT 5",
        "nt_by_predicate": w + "SELECT * FROM triples WHERE contains(p, '#type') AND starts_with(o, 'http')",
        "nt_count": f"""SELECT 5 * {n_cust} + 4 * {n_nat} + 13 * {n_reg} AS n_lines, 2 * {n_reg} AS n_comment,
  2 * {n_reg} AS n_blank, 5 * {n_cust} + 4 * {n_nat} + 7 * {n_reg} AS n_triples, 2 * {n_reg} AS n_malformed""",
        "nt_count_files": f"""SELECT 5 * {n_cust} + 4 * {n_nat} + 13 * {n_reg} AS n_lines, 2 * {n_reg} AS n_comment,
  2 * {n_reg} AS n_blank, 5 * {n_cust} + 4 * {n_nat} + 7 * {n_reg} AS n_triples, 2 * {n_reg} AS n_malformed""",
        "subject_counts": w + "SELECT s, count(*) AS n FROM triples GROUP BY s",
        "class_counts": w + f"SELECT o AS class, count(*) AS n FROM triples WHERE p = '{_RDF_TYPE}' AND o_kind = 'iri' AND starts_with(o, 'http') GROUP BY o",
        "top_subjects": w + "SELECT s, count(*) AS n FROM triples GROUP BY s ORDER BY n DESC, s LIMIT 5",
        "top_typed_subjects": w + f"SELECT s, count(*) AS n FROM triples WHERE p = '{_RDF_TYPE}' AND o_kind = 'iri' AND starts_with(o, 'http') GROUP BY s ORDER BY n DESC, s LIMIT 5",
    }


def taxonomy_sql() -> dict[str, str]:
    w = f"WITH RECURSIVE {EDGES_CTE.strip()},\n{CLOSURE_CTE.strip()}\n"
    ns = B.TAXO_NS
    return {
        "taxo_edges": w + "SELECT DISTINCT k, child, parent FROM edges",
        "taxo_edges_files": w + "SELECT DISTINCT k, child, parent FROM edges",
        "tsv_rows": f"""SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment, c_acctbal::DECIMAL(15,2)::VARCHAR AS c_acctbal,
  NULL::VARCHAR AS line FROM customer
UNION ALL SELECT NULL, NULL, NULL, NULL, 'short' || chr(9) || c_custkey FROM customer WHERE c_custkey % {B.SHORT_EVERY} = 7
UNION ALL SELECT NULL, NULL, NULL, NULL, 'long' || chr(9) || c_custkey || repeat(chr(9) || 'x', {len(B.TSV_COLUMNS) - 1})
  FROM customer WHERE c_custkey % {B.LONG_EVERY} = 3""",
        "taxo_concepts": w + "SELECT k, child AS concept FROM edges UNION SELECT k, parent FROM edges",
        "taxo_children": w + """, e AS (SELECT DISTINCT k, parent, child FROM edges)
SELECT e.k, e.parent, e.child, c.n AS n_children FROM e JOIN (SELECT k, parent, count(*) AS n FROM e GROUP BY k, parent) c
  ON c.k = e.k AND c.parent = e.parent""",
        "taxo_closure": w + "SELECT k, anc, leaf, depth FROM clo_min",
        "taxo_descendants": w + "SELECT leaf FROM clo_min WHERE k = 0 AND anc = 'EUROPE' AND depth > 0",
        "taxo_intervals": w + """, inner_ AS (SELECT DISTINCT k, parent AS concept FROM edges),
walk(k, concept, path, depth) AS (
  SELECT k, concept, k::VARCHAR || concept || chr(1), 0 FROM inner_ i
  WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.k = i.k AND e.child = i.concept)
  UNION ALL
  SELECT e.k, e.child, w.path || CASE WHEN i.concept IS NULL THEN '0' ELSE '1' END || e.child || chr(1), w.depth + 1
  FROM walk w JOIN edges e ON e.k = w.k AND e.parent = w.concept LEFT JOIN inner_ i ON i.k = e.k AND i.concept = e.child),
below AS (SELECT k, anc, count(*) AS n FROM clo_min GROUP BY k, anc),
placed AS (SELECT k, concept, depth, row_number() OVER (ORDER BY path) - 1 AS lo FROM walk)
SELECT p.k, concept, lo, lo + 1 + coalesce(n, 0) AS hi, depth FROM placed p LEFT JOIN below b ON b.k = p.k AND b.anc = concept""",
        "uri_dictionary": w + f""", terms AS (SELECT k, child AS c FROM edges UNION SELECT k, parent FROM edges)
SELECT CASE k WHEN 0 THEN '{ns[0]}' WHEN 1 THEN '{ns[1]}' ELSE '{ns[2]}' END || c AS uri, c AS local_name FROM terms
UNION SELECT '{B.OWL_CLASS}', 'Class'""",
    }


# --- graph ---------------------------------------------------------------------
def _graph_ctes(triples_cte: str) -> str:
    return f"""WITH RECURSIVE {triples_cte.strip()},
terms AS (SELECT s AS label FROM triples UNION SELECT o FROM triples),
v AS (SELECT row_number() OVER (ORDER BY label) - 1 AS id, label FROM terms),
e AS (SELECT vs.id AS src, vo.id AS dst, t.p AS attr FROM triples t JOIN v vs ON vs.label = t.s JOIN v vo ON vo.label = t.o)"""


SUPPLY_CTE = """
triples(s, p, o) AS (
  SELECT 'supplier/' || l_suppkey, 'supplies', 'part/' || l_partkey FROM lineitem
)"""


def _pagerank_ctes(iters: int, edges: str = "e") -> str:
    parts = [f"""w AS (
  SELECT m.src, m.dst, m.m / d.d AS w FROM (SELECT src, dst, count(*) AS m FROM {edges} GROUP BY src, dst) m
  JOIN (SELECT src, count(*) AS d FROM {edges} GROUP BY src) d ON d.src = m.src
)""", "r0 AS (SELECT id, 1.0::DOUBLE AS rank FROM v)"]
    for i in range(1, iters + 1):
        parts.append(f"""r{i} AS (
  SELECT v.id, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(c.s, 0.0::DOUBLE) AS rank FROM v LEFT JOIN (
    SELECT w.dst, sum(p.rank * w.w) AS s FROM w JOIN r{i - 1} p ON p.id = w.src GROUP BY w.dst
  ) c ON c.dst = v.id
)""")
    return ",\n".join(parts)


def _components(edges: str) -> str:
    return f"""ue AS (SELECT src AS a, dst AS b FROM {edges} WHERE src <> dst UNION SELECT dst, src FROM {edges} WHERE src <> dst),
reach(x, c) AS (
  SELECT id, id FROM v
  UNION SELECT ue.b, reach.c FROM reach JOIN ue ON ue.a = reach.x WHERE reach.c < ue.b
)
SELECT x AS id, min(c) AS component FROM reach GROUP BY x"""


def graph_sql() -> dict[str, str]:
    g = _graph_ctes(TRIPLES_CTE)
    sub = f"sub AS (SELECT * FROM e WHERE attr = '{B.SCHEMA}inNation')"
    it = 20
    pr = g + ",\n" + _pagerank_ctes(it)
    out = {
        "graph_vertices": g + "\nSELECT * FROM v",
        "graph_order_line_vertices": """WITH t AS (
  SELECT 'order/' || l_orderkey AS label FROM lineitem
  UNION SELECT 'order/' || l_orderkey || '/line/' || l_linenumber FROM lineitem)
SELECT row_number() OVER (ORDER BY label) - 1 AS id, label FROM t""",
        "graph_edges": g + "\nSELECT * FROM e",
        "graph_subgraph": g + f"\nSELECT * FROM e WHERE attr = '{B.SCHEMA}inNation'",
        "graph_degree": g + "\nSELECT src AS id, count(*) AS out_degree FROM e GROUP BY src",
        "graph_components": g + ",\n" + sub + ",\n" + _components("sub"),
        "graph_pagerank": pr + f"\nSELECT r.id, v.label, round(r.rank * 1048576.0) / 1048576.0 AS rank FROM r{it} r JOIN v USING (id)",
        "graph_pagerank_top": pr + f"""
SELECT r.id, v.label, round(r.rank * 1048576.0) / 1048576.0 AS rank FROM r{it} r JOIN v USING (id)
ORDER BY round(r.rank * 1048576.0) / 1048576.0 DESC, v.label LIMIT 5""",
    }
    # the triple graph has no cycles, so the ranks are exact after as many rounds as its longest path
    out["graph_pagerank_tol"] = pr + f"""
SELECT r.id, v.label, round(r.rank * (SELECT count(*) / sum(rank) FROM r{it}) * 1048576.0) / 1048576.0 AS rank
FROM r{it} r JOIN v USING (id)"""
    sg = _graph_ctes(SUPPLY_CTE)
    out["graph_supply_components"] = sg + ",\n" + _components("e")
    out["graph_supply_pagerank"] = sg + ",\n" + _pagerank_ctes(it) + f"""
SELECT r.id, v.label, round(r.rank * 1048576.0) / 1048576.0 AS rank FROM r{it} r JOIN v USING (id)"""
    return out


# --- text -------------------------------------------------------------------------
_WS = r"list_filter(string_split_regex(lower(text), '\s'), lambda x: x <> '')"
_RX = r"list_filter(string_split_regex(lower(text), '\W'), lambda x: x <> '')"
_GRID = 1048576.0


_JAVA_WS = r"[ \t\n\x0B\f\r]"
_WORD = 4294967296  # arithmetic modulo 2**32


def _rotl(x: str, bits: int) -> str:
    return f"((({x}) << {bits}) | (({x}) >> {32 - bits})) % {_WORD}"


def _hashed_tfidf_sql(buckets: int) -> str:
    """Bucketed TF-IDF: MurmurHash3 (32 bit, seed 42) of a term's UTF-8 bytes, non-negative remainder."""
    mixed = "list_transform(list_transform(list_transform({0}, lambda x: x * 3432918353 % {1}), lambda x: {2}), lambda x: x * 461845907 % {1})"
    mix = lambda blocks: mixed.format(blocks, _WORD, _rotl("x", 15))
    byte = lambda at: f"substr(h, {at}, 2)"
    block = "('0x' || " + " || ".join(byte(f"8 * i + {at}") for at in (7, 5, 3, 1)) + ")::UBIGINT"
    tail = "('0x0' || " + " || ".join(byte(f"8 * (n // 4) + {at}") for at in (5, 3, 1)) + ")::UBIGINT"
    return f"""WITH toks AS (
  SELECT doc_id, unnest(CASE WHEN text <> '' AND bare = '' THEN [] ELSE string_split_regex(bare, '{_JAVA_WS}') END) AS term
  FROM (SELECT doc_id, text, regexp_replace(lower(text), '{_JAVA_WS}+$', '') AS bare FROM documents)),
hx AS (SELECT term, hex(encode(term)) AS h, octet_length(encode(term)) AS n FROM (SELECT DISTINCT term FROM toks)),
ks AS (SELECT term, n, {mix(f"list_transform(range(0, n // 4), lambda i: {block})")} AS body, {mix(f"[{tail}]")}[1] AS rest FROM hx),
h1 AS (SELECT term, xor(xor(list_reduce(list_prepend(42::UBIGINT, body),
         lambda a, k: (({_rotl("xor(a, k)", 13)}) * 5 + 3864292196) % {_WORD}), rest), n::UBIGINT) AS a FROM ks),
h2 AS (SELECT term, xor(a, a >> 16) * 2246822507 % {_WORD} AS a FROM h1),
h3 AS (SELECT term, xor(a, a >> 13) * 3266489909 % {_WORD} AS a FROM h2),
h4 AS (SELECT term, xor(a, a >> 16)::BIGINT AS a FROM h3),
b AS (SELECT term, ((CASE WHEN a >= 2147483648 THEN a - {_WORD} ELSE a END) % {buckets} + {buckets}) % {buckets} AS b FROM h4),
tf AS (SELECT doc_id, b, count(*) AS tf FROM toks JOIN b USING (term) GROUP BY doc_id, b),
df AS (SELECT b, count(*) AS df FROM tf GROUP BY b),
n AS (SELECT count(*)::DOUBLE AS n FROM documents),
v AS (SELECT doc_id, b, round(tf * ln((n + 1.0) / (df::DOUBLE + 1.0)) * {_GRID}) / {_GRID} AS v FROM tf JOIN df USING (b), n)
SELECT d.doc_id, list(coalesce(v.v, 0.0::DOUBLE) ORDER BY g.b) AS features
FROM documents d CROSS JOIN (SELECT unnest(range({buckets})) AS b) g LEFT JOIN v ON v.doc_id = d.doc_id AND v.b = g.b
GROUP BY d.doc_id"""


def text_sql() -> dict[str, str]:
    return {
        "tokens_ws": f"SELECT doc_id, {_WS} AS tokens FROM documents",
        "tokens_regex": f"SELECT doc_id, {_RX} AS tokens FROM documents",
        "tfidf_hashed": _hashed_tfidf_sql(20),
        "token_counts": f"SELECT doc_id, len({_WS})::INTEGER AS n_ws, len({_RX})::INTEGER AS n_regex FROM documents",
        # a fit is optimal exactly if every slope of its loss is zero; the expected positives are then the real ones
        "lr_optimum": """SELECT 1 AS class, f.feature::INTEGER AS feature, 0.0::DOUBLE AS gradient, l.positives
FROM (SELECT unnest(range(-1, 32)) AS feature) f,
     (SELECT sum(quality)::BIGINT AS positives FROM documents JOIN labels USING (doc_id)) l""",
        "count_vectors": f"""WITH toks AS (SELECT doc_id, unnest({_WS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS n FROM toks GROUP BY doc_id, term),
vocabulary AS (SELECT term, (row_number() OVER (ORDER BY count(*) DESC, term) - 1)::INTEGER AS i FROM tf GROUP BY term
  QUALIFY i < 500),
held AS (SELECT doc_id, list(i ORDER BY i) AS indices, list(n ORDER BY i) AS counts FROM tf JOIN vocabulary USING (term) GROUP BY doc_id)
SELECT doc_id, coalesce(indices, []) AS indices, coalesce(counts, []) AS counts FROM documents LEFT JOIN held USING (doc_id)""",
        "tfidf_terms": f"""WITH toks AS (SELECT doc_id, unnest({_WS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*)::DOUBLE AS n FROM documents)
SELECT doc_id, term, tf, df,
       round(ln((n + 1.0) / (df::DOUBLE + 1.0)) * {_GRID}) / {_GRID} AS idf,
       round(tf * ln((n + 1.0) / (df::DOUBLE + 1.0)) * {_GRID}) / {_GRID} AS tfidf
FROM tf JOIN df USING (term), n""",
    }


# --- set algebra ----------------------------------------------------------------------
def _concept_rows(k: int, concept: str) -> str:
    return f"SELECT f.* FROM facts f WHERE f.id IN (SELECT id FROM item WHERE k = {k} AND concept = {_q(concept)})"


def sets_sql() -> dict[str, str]:
    base = f"WITH RECURSIVE {EDGES_CTE.strip()},\n{CLOSURE_CTE.strip()},\n{FACTS_CTE.strip()},\n{ANC_CTE.strip()},\n{_item_cte(True).strip()}"
    rules = _rules_cte(**FIRST) + ",\n" + _topk(1) + """,
best_ids AS (
  SELECT DISTINCT c.id FROM cand c JOIN topk r
    ON c.c0 IS NOT DISTINCT FROM r.c0 AND c.c1 IS NOT DISTINCT FROM r.c1 AND c.c2 IS NOT DISTINCT FROM r.c2
)"""
    return {
        "set_intersect": base + "\n" + _concept_rows(0, "EUROPE") + "\nINTERSECT\n" + _concept_rows(1, "Industrial")
        + "\nINTERSECT\n" + _concept_rows(2, "Expedited"),
        "set_union": base + "\n" + _concept_rows(0, "AFRICA") + "\nUNION\n" + _concept_rows(0, "AMERICA")
        + "\nUNION\n" + _concept_rows(1, "Consumer"),
        "set_except": base + "\n" + _concept_rows(0, "EUROPE") + "\nEXCEPT\n" + _concept_rows(1, "Industrial"),
        "join_all_cols": rules + """
SELECT p.id, p.customer, p.nation, p.segment, p.priority, p.price_band, p.target, 50 - 1 AS counter
FROM facts p JOIN (SELECT f.* FROM facts f WHERE f.id IN (SELECT id FROM best_ids) AND f.target) w
  ON p.id = w.id AND p.customer = w.customer AND p.nation = w.nation AND p.segment = w.segment AND p.priority = w.priority
 AND p.price_band = w.price_band AND p.target = w.target
WHERE p.target""",
        "cover_missing": rules + "\nSELECT f.* FROM facts f WHERE f.target AND f.id NOT IN (SELECT id FROM best_ids)",
        "distinct_values": "WITH " + FACTS_CTE.strip() + """
SELECT DISTINCT 'customer' AS "column", customer AS value FROM facts WHERE customer IS NOT NULL
UNION SELECT 'segment', segment FROM facts WHERE segment IS NOT NULL
UNION SELECT 'priority', priority FROM facts WHERE priority IS NOT NULL
UNION SELECT 'price_band', price_band FROM facts WHERE price_band IS NOT NULL""",
        "target_filter": "WITH " + FACTS_CTE.strip() + "\nSELECT * FROM facts WHERE target AND nation LIKE 'NATION_1%'",
        "project": "WITH " + FACTS_CTE.strip() + "\nSELECT id, nation FROM facts",
    }
