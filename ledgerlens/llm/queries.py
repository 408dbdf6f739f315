"""The queries of this package and, where SQL can express them, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, hard_negatives, license_scans, line_dedup, media, mixing, ngram_jaccard, prefix_trie, quality_rules, sharding, token_counts, toxicity, url_filters
from .common import shared_dir

#: The tokenizer file that the queries use; a parameter of the operators.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), url_filters.rule_table(spark))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own for each call: the query shows the whole work, not what an earlier call has left
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary(), shared_dir(spark))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored_texts(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.linked(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scans.scan(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_line_dedup, op3_quality_rules, op4_url_filters, op5_token_counts, op6_sharding, op7_media_columns, op8_ngram_jaccard, op9_bpe, op10_license_scans,
        op11_prefix_trie, op12_hard_negatives, op13_toxicity,
    )
}

_STOP = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
l AS (
  SELECT r, doc_id, i, s[i] AS line, len(regexp_extract_all(s[i], '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT r, doc_id, string_split(text, chr(10)) AS s FROM d), LATERAL (SELECT unnest(range(1, len(s) + 1)) AS i)),
n AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY i) AS p FROM l WHERE w > 0),
a AS (
  SELECT r, doc_id, p, [i] AS at1, [i, lead(i) OVER v] AS at2, [i, lead(i) OVER v, lead(i, 2) OVER v] AS at3,
         line AS t1, lead(line) OVER v AS t2, lead(line, 2) OVER v AS t3,
         w AS w1, lead(w) OVER v AS w2, lead(w, 2) OVER v AS w3
  FROM n WINDOW v AS (PARTITION BY r ORDER BY p)),
windows AS (
  SELECT r, doc_id, p, at1 AS places, t1 AS t FROM a WHERE w1 >= 50
  UNION ALL SELECT r, doc_id, p, at2, t1 || chr(10) || t2 FROM a
    WHERE t2 IS NOT NULL AND w1 + w2 >= 50 AND (w1 < 50 OR w2 < 50)
  UNION ALL SELECT r, doc_id, p, at3, t1 || chr(10) || t2 || chr(10) || t3 FROM a
    WHERE t3 IS NOT NULL AND (w1 + w2 < 50 OR w2 + w3 < 50)),
gone AS (
  SELECT DISTINCT r, unnest(places) AS i
  FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, r, p) AS k FROM windows) WHERE k > 1),
kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE g.i IS NULL) AS text,
         count(*) FILTER (WHERE w > 0) AS n_lines, count(g.i) AS n_removed
  FROM l LEFT JOIN gone g USING (r, i) GROUP BY r)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM d LEFT JOIN kept USING (r)""",
    "op3_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 5) AS s(k) GROUP BY r),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS BIGINT) AS n_stop_words,
         CAST(len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS BIGINT) AS n_stutters
  FROM d LEFT JOIN covered c ON d.r = c.r)
SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {quality_rules.verdict_sql()} AS kept
FROM m""",
    "op4_url_filters": r"""
WITH r(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
p AS (
  SELECT row_number() OVER () AS k, page_id,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT k, page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
best AS (
  SELECT k, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(r.verdict, length(rh || rp)) AS verdict
  FROM u JOIN r ON (u.host = rh OR ends_with(u.host, '.' || rh)) AND starts_with(u.path, rp)
  GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (k)""",
    "op11_prefix_trie": r"""
WITH steps AS (
  SELECT [list_reduce([k] || range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384)) FOR k IN range(256)] AS t),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 20 AS first,
         xor(list_reduce([4294967295] || [ascii(z) FOR z IN string_split(CAST(c AS VARCHAR), '')],
                         lambda v, b: xor(v >> 8, t[(xor(v, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns), steps),
joined AS (
  SELECT v.c, 0 AS own, pos, role, text FROM convs v JOIN turns t ON t.c = v.first AND t.pos < v.h
  UNION ALL SELECT v.c, 1, pos, role, text FROM convs v JOIN turns t ON t.c = v.c AND t.pos >= v.h),
made AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS depth FROM joined),
pre AS (
  SELECT c, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         sha256(string_agg(sha256(role) || sha256(text), '' ORDER BY depth) OVER (PARTITION BY c ORDER BY depth)) AS k
  FROM made
  UNION ALL SELECT c, 0, 0, '' FROM convs),
linked AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY depth) AS pk FROM pre),
nodes AS (
  SELECT depth, k, any_value(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words
  FROM linked GROUP BY depth, k),
kids AS (SELECT pk AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY pk),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (k)),
sums AS (
  SELECT a.k, count(*) FILTER (WHERE d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.words) AS saved_tokens
  FROM full_nodes d JOIN pre a ON a.c = d.conv_id AND a.depth <= d.depth GROUP BY a.k),
last AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends
         FROM (SELECT c, arg_max(k, depth) AS k FROM pre GROUP BY c) GROUP BY k)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM full_nodes n JOIN sums USING (k) LEFT JOIN nodes p ON p.k = n.pk LEFT JOIN last ON last.k = n.k""",
    "op12_hard_negatives": r"""
WITH e AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.n AS an, a.vec_id AS anchor_id, b.n AS bn, b.vec_id, a.label = b.label AS same,
         CAST(list_sum([x[1] * x[2] FOR x IN list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM e a JOIN e b ON a.n <> b.n WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY an ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5),
neg AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.an, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM pos p JOIN s ON s.an = p.an AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10""",
}
