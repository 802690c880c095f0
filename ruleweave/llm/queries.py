"""Queries of the corpus operators over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.llm import (ann, fingerprints, html_text, langid, lexical, nbest, neardup, packing, prefix_trie, quality,
                           secrets, token_counts, warc)
from ruleweave.llm.common import read_table

BYTE_BPE = {"json_path": public_tokenizers.path("byte_bpe_50k.json"),
            "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), **BYTE_BPE)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(read_table(spark, sf_dir, "documents")))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "n_words")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op6_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.nbest_digest(read_table(spark, sf_dir, "documents"), PIECES, n=3)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), PIECES)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return quality.score_quality(read_table(spark, sf_dir, "documents"), labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, captures = warc.archive_pages(read_table(spark, sf_dir, "pages"))
    at = index.select("archive", "at", "position").hint("merge")
    return captures.join(at, ["archive", "at"]).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "position")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "benchmark"), read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_packing, op3_secret_scan, op4_language_id, op5_html_text, op6_nbest_segmentation,
    op7_token_counts, op8_quality_rules, op9_nearest_neighbours, op10_warc, op11_prefix_trie,
    op12_fingerprints, op13_lexical_search)}

ORACLE = {
    "op10_warc": r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
         octet_length(encode(coalesce(html, ''))) AS payload_bytes
  FROM pages),
k AS (
  SELECT *, regexp_replace(url, '#.*$', '') AS bare FROM p),
h AS (
  SELECT *, regexp_replace(lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^.*@|:[0-9]*$', '', 'g') AS host,
         regexp_replace(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') AS rest
  FROM k),
f AS (
  SELECT payload_digest AS d, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to,
       row_number() OVER (ORDER BY array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || rest,
                          coalesce(page_id % 31536000, 0), page_id NULLS FIRST) - 1 AS position
FROM h LEFT JOIN f ON payload_digest = d AND payload_bytes >= 100
""",
    # crc32 is the driver's own choice of h; its 256 entries are made by rule
    "op11_prefix_trie": r"""
WITH RECURSIVE poly(i, step, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, step + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM poly WHERE step < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM poly WHERE step = 8),
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, length(coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, z, v) AS (
  SELECT DISTINCT conv_id, 0, 4294967295::BIGINT FROM t
  UNION ALL
  SELECT conv_id, z + 1, xor(crc_table.t[(xor(v, ascii(substr(conv_id::VARCHAR, z + 1, 1))) & 255) + 1], v >> 8)
  FROM crc, crc_table WHERE z < length(conv_id::VARCHAR)),
h AS (SELECT conv_id, xor(v, 4294967295) % 6 AS h FROM crc WHERE z = length(conv_id::VARCHAR)),
turns AS (
  SELECT h.conv_id, t.pos, k, n FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 100 WHERE t.pos <= h
  UNION ALL SELECT conv_id, t.pos, k, n FROM h JOIN t USING (conv_id) WHERE t.pos > h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS d, k, n FROM turns),
path AS (
  SELECT a.conv_id, a.d, a.n, string_agg(b.k, '' ORDER BY b.d) AS p
  FROM placed a JOIN placed b ON a.conv_id = b.conv_id AND b.d <= a.d GROUP BY a.conv_id, a.d, a.n
  UNION ALL SELECT conv_id, 0, 0, '' FROM h),
node AS (SELECT p, d, max(n) AS n, min(conv_id) AS conv_id, count(*) AS n_convs FROM path GROUP BY p, d),
kids AS (SELECT left(p, 32 * (d - 1)::INT) AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
sub AS (
  SELECT u.p, sum((x.n_convs - 1) * x.n) AS saved, count(*) FILTER (WHERE k.p IS NULL) AS n_leaves
  FROM node x LEFT JOIN kids k ON k.p = x.p JOIN path u ON u.conv_id = x.conv_id AND u.d <= x.d GROUP BY u.p),
ended AS (
  SELECT p, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(p, d) AS p FROM path GROUP BY conv_id) GROUP BY p)
SELECT x.conv_id, x.d AS depth, CASE WHEN x.d > 0 THEN up.conv_id END AS parent_conv_id, x.n_convs,
       coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node x JOIN sub s ON s.p = x.p LEFT JOIN kids k ON k.p = x.p LEFT JOIN ended e ON e.p = x.p
LEFT JOIN node up ON x.d > 0 AND up.p = left(x.p, 32 * (x.d - 1)::INT)
""",
    "op13_lexical_search": r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(terms) AS term FROM item) GROUP BY 1, 2),
total AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc WHERE len(terms) > 0),
posting AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM doc)
  WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2, 3),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM posting, total GROUP BY term),
score AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN posting USING (term), total GROUP BY 1, 2),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""",
}
