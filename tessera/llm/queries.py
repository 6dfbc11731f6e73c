"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, fingerprints, langid, line_dedup, mixing, packing, periodic_runs, prefix_trie,
               quality_rules, simhash, suffix_dedup, token_counts, token_files)

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""


@query("op1_exact_dedup", OP1_SQL)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of documents: local, salted, then global combining on full texts."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), pos AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
), tri AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM pos
), dup AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c >= 2
), cov AS (
  SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words FROM dup, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, w.source, len(words) AS n_words,
         len(array_to_string(words, '')) AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
         - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))
           AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id
), b AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m
), h AS (
  SELECT source, count(*) AS n, sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS f FROM b GROUP BY source
), s AS (
  SELECT sum(n) AS n, sum(f) / sum(n) AS mu, count(*) AS h, sum(1.0 * f * f / n) AS q FROM h
), prior AS (
  SELECT mu, CASE WHEN q / n - mu * mu - mu * (1 - mu) * (h - 1) / n > 0 AND mu * (1 - mu) > 0
         THEN least(1e6, greatest(0.0, mu * (1 - mu) / (q / n - mu * mu - mu * (1 - mu) * (h - 1) / n) - 1))
         ELSE 1e6 END AS strength FROM s
), v AS (
  SELECT source, (f + mu * strength) / (n + strength) <= 0.5 AS host_ok FROM h, prior
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, (NOT base_failed AND host_ok) AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""


@query("op9_quality_rules", OP9_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules per document, failures shrunk per source with a beta prior, verdicts joined back."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of documents, linked at 3 differing bits or fewer by pigeonhole probing."""
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query("op4_mixing")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors learned from labels, and document rates that meet the domain token targets."""
    return mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token lengths of documents packed by best fit into sequences of five permitted lengths."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of documents from prefix tables, and the longest prefix within 2048 tokens."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token ids in flat files with 64-bit offsets, written in doc_id order and read back."""
    return token_files.token_files(table(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a byte convolutional network fitted on the labelled part."""
    return langid.identify_language(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), w AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), x AS (
  SELECT doc_id, k, line, nw, lead(line, 1) OVER d AS line2, lead(nw, 1) OVER d AS nw2, lead(line, 2) OVER d AS line3
  FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY k)
), g AS (
  SELECT doc_id, k, 1 AS size, line AS key FROM x WHERE nw >= 10
  UNION ALL SELECT doc_id, k, 2, line || chr(10) || line2 FROM x WHERE nw + nw2 >= 10
  UNION ALL SELECT doc_id, k, 3, line || chr(10) || line2 || chr(10) || line3 FROM x
), later AS (
  SELECT doc_id, k, size FROM (SELECT doc_id, k, size, row_number() OVER (PARTITION BY key ORDER BY doc_id, k) AS nth
                               FROM g WHERE key IS NOT NULL) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, k + d AS k FROM later, (SELECT unnest([0, 1, 2]) AS d) WHERE d < size
), runs AS (
  SELECT doc_id, count(*) AS n_removed, sum(CASE WHEN prev IS NULL OR prev < k - 1 THEN 1 ELSE 0 END) AS n_runs
  FROM (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS prev FROM gone) GROUP BY doc_id
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS t, count(w.k) AS n_kept
  FROM l LEFT JOIN w ON l.doc_id = w.doc_id AND l.i = w.i
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = w.doc_id AND gone.k = w.k) GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_kept, 0) + coalesce(n_removed, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, sha256(coalesce(t, '')) AS kept_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN runs ON d.doc_id = runs.doc_id
"""


@query("op5_line_dedup", OP5_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of three lines, or of ten words in fewer lines, that repeat an earlier place are deleted, found by winnowing."""
    return (line_dedup.line_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256")))


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of documents covered by a 400-byte string that also starts elsewhere, removed."""
    return (suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in documents, by maximal pairs over an LCP-interval tree."""
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


@query("op13_fingerprints")
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Homomorphic multiset hashes of documents and of their edited texts, and how alike they are."""
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, count(*) AS len, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_concat([4294967295::UBIGINT],
                         list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
                         lambda r, b: list_reduce(list_concat([xor(r, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
                         lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)),
             4294967295::UBIGINT) % 4 AS h
  FROM t GROUP BY conv_id
), k AS (
  SELECT c.*, least(c.h, coalesce(b.len, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base
), s AS (
  SELECT k.conv_id, t.pos AS depth, t.role, t.text FROM k JOIN t ON t.conv_id = k.base AND t.pos <= k.h
  UNION ALL SELECT k.conv_id, t.pos - k.h + k.taken, t.role, t.text FROM k JOIN t ON t.conv_id = k.conv_id AND t.pos > k.h
), m AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, max(depth) OVER (PARTITION BY conv_id) AS len,
         list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS prefix FROM s
  UNION ALL SELECT conv_id, 0, 0, coalesce((SELECT max(depth) FROM s WHERE s.conv_id = c.conv_id), 0), [] FROM c
), n AS (
  SELECT min(conv_id) AS conv_id, depth, prefix, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(CASE WHEN depth = len THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM m GROUP BY depth, prefix
), mine AS (
  SELECT m.conv_id, m.depth, n.conv_id AS owner FROM m JOIN n ON m.depth = n.depth AND m.prefix = n.prefix
), p AS (
  SELECT n.*, u.owner AS parent FROM n LEFT JOIN mine u ON u.conv_id = n.conv_id AND u.depth = n.depth - 1
), kids AS (
  SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM p WHERE depth > 0 GROUP BY ALL
), q AS (
  SELECT p.*, coalesce(n_children, 0) AS n_children FROM p LEFT JOIN kids USING (conv_id, depth)
), sub AS (
  SELECT u.owner AS conv_id, u.depth, sum(CASE WHEN q.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((q.n_convs - 1) * q.words) AS saved_tokens
  FROM q JOIN mine u ON u.conv_id = q.conv_id AND u.depth <= q.depth GROUP BY ALL
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM q JOIN sub USING (conv_id, depth)
"""


@query("op12_prefix_trie", OP12_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of rebuilt conversations; subtree leaves and savings from a ranked Euler tour."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), rebuild=True)
