"""Queries of the filtering operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import decontaminate, licenses, linededup, quality
from logloom.llm.common import query, table

# The line rules of quality.py in SQL; \x27 is a quote.
_OP9 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents
), tri AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d
), t3 AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM tri
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM t3 WHERE n >= 2) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(ls) AS l FROM d
), judged AS (
  SELECT doc_id, l, len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM lines
), verdict AS (
  SELECT doc_id, l, n,
         n > 0 AND (NOT regexp_matches(l, '[\p{L}\p{N}]')
           OR (len(regexp_extract_all(l, '[|•»>]')) >= 2 AND len(regexp_extract_all(l, '[|•»>]')) * 4 >= n)
           OR len(regexp_extract_all(l, '[#*$%&|<>]')) * 2 > n
           OR BOILERPLATE
           OR (n < 3 AND NOT regexp_matches(l, '[.!?:;,…。！？"\x27)\]»”’][\x20\x09-\x0D]*$'))) AS bad
  FROM judged
), per AS (
  SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS n_dup_lines,
         coalesce(sum(n) FILTER (bad), 0) AS lost
  FROM verdict GROUP BY doc_id
), m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, lost
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN per USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost <= 50 * n_words AS kept
FROM m
""".replace("BOILERPLATE", " OR ".join(f"contains(lower(l), '{p}')" for p in quality.BOILERPLATE))


@query(_OP9)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every document."""
    return quality.assess(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_OP4 = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS x
  FROM (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS x
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)
), m AS (
  SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, x)
), h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS sha
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query(_OP4)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words, items and verdict of every document."""
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


_OP10 = r"""
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), k AS (
  SELECT doc_id, list_transform(ls, lambda x: translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ks, ls
  FROM l
), p AS (
  SELECT doc_id, unnest(ls) AS line, unnest(ks) AS key, unnest(range(1, len(ls) + 1)) AS i FROM k
), f AS (
  SELECT key FROM p WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), j AS (
  SELECT doc_id, line, i, f.key IS NULL AS stays FROM p LEFT JOIN f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


@query(_OP10)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped and a digest of what stays, of every document."""
    done = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def _values() -> str:
    return ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(licenses.TEMPLATES))


_OP7 = r"""
WITH tt(template, license, text) AS (VALUES TEMPLATES), tw AS (
  SELECT template, license, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM tt
), tp AS (
  SELECT DISTINCT template, license, w[i] || ' ' || w[i + 1] AS pair
  FROM (SELECT template, license, w, unnest(range(1, len(w))) AS i FROM tw)
), ts AS (
  SELECT template, license, count(*) AS size FROM tp GROUP BY ALL
), u AS (
  SELECT DISTINCT doc_id, unnest(list_concat(list_concat(string_split(text, chr(10)),
           CASE WHEN regexp_matches(text, '\n[ \t\r]*\n') THEN regexp_split_to_array(text, '\n[ \t\r]*\n') ELSE [] END),
           CASE WHEN contains(text, chr(10)) THEN [text] ELSE [] END)) AS unit
  FROM documents WHERE text IS NOT NULL
), uw AS (
  SELECT doc_id, unit, list_filter(string_split(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM u
), up AS (
  SELECT DISTINCT doc_id, unit, w[i] || ' ' || w[i + 1] AS pair
  FROM (SELECT doc_id, unit, w, unnest(range(1, len(w))) AS i FROM uw)
), us AS (
  SELECT doc_id, unit, count(*) AS n FROM up GROUP BY ALL
), c AS (
  SELECT doc_id, unit, template, license, count(*) AS common FROM up JOIN tp USING (pair) GROUP BY ALL
), f AS (
  SELECT doc_id, c.license, max(2.0::DOUBLE * common / (n + size)) AS dice
  FROM c JOIN us USING (doc_id, unit) JOIN ts USING (template)
  WHERE 2.0::DOUBLE * common / (n + size) >= 0.8 GROUP BY ALL
), b AS (
  SELECT doc_id, arg_min(license, struct_pack(d := -dice, l := license)) AS license, max(dice) AS dice,
         string_agg(license, ',' ORDER BY license) AS licenses
  FROM f GROUP BY doc_id
)
SELECT doc_id, license, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN b USING (doc_id)
""".replace("TEMPLATES", _values())


@query(_OP7)
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))
