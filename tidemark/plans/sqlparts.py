"""Reusable SQL text for the DuckDB oracle queries.

These are independent formulations of the same rules (RE2 has no back-references,
so runs of equal characters are found with gaps-and-islands instead of a regex).
"""

from __future__ import annotations

from ..functions.fixed import NA_TEXTS, PY_WHITESPACE_CLASS, WORD_CLASS

WS = PY_WHITESPACE_CLASS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


NA_LIST = ", ".join(q(x) for x in NA_TEXTS)
HAS_TEXT = f"text IS NOT NULL AND text NOT IN ({NA_LIST})"


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {q(rf'\A[{WS}]+|[{WS}]+\z')}, '', 'g')"


def clean_ctes(src: str, key: str, text: str, prefix: str = "cl") -> tuple[str, str]:
    """CTEs that clean ``text`` of ``src`` keyed by ``key``; returns (ctes, final cte name).

    The final CTE has columns (key, clean).
    """
    url = q(rf"https?://[^{WS}]+")
    nonword = q(rf"[^{WORD_CLASS}{WS}]")
    ctes = f"""
{prefix}_s AS (
  SELECT {key} AS k, regexp_replace(regexp_replace({strip_sql(text)}, {url}, '', 'g'),
                                   {nonword}, ' ', 'g') AS t
  FROM {src}),
{prefix}_c AS (
  SELECT k, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS i
  FROM {prefix}_s WHERE length(t) > 0),
{prefix}_g AS (
  SELECT k, i, c, i - row_number() OVER (PARTITION BY k, c ORDER BY i) AS grp FROM {prefix}_c),
{prefix}_r AS (
  SELECT k, i, c,
         count(*) OVER (PARTITION BY k, c, grp) AS run_len,
         row_number() OVER (PARTITION BY k, c, grp ORDER BY i) AS pos
  FROM {prefix}_g),
{prefix}_j AS (
  SELECT k, string_agg(c, '' ORDER BY i) AS t FROM {prefix}_r
  WHERE c = chr(10) OR run_len < 4 OR pos <= 2 GROUP BY k),
{prefix} AS (
  SELECT s.k AS {key}, {strip_sql("coalesce(j.t, '')")} AS clean
  FROM {prefix}_s s LEFT JOIN {prefix}_j j ON s.k = j.k)"""
    return ctes, prefix


def topic_docs_ctes() -> str:
    """CTE ``td``: (doc_id, stock_id, lang, text, cluster_fine, cluster_medium)."""
    ctes, name = clean_ctes(f"(SELECT doc_id, text FROM documents WHERE {HAS_TEXT})", "doc_id", "text")
    return ctes + f""",
td AS (
  SELECT d.doc_id, d.source AS stock_id, d.lang, c.clean AS text,
         v.label AS cluster_fine, CAST(floor(v.label / 3) AS INTEGER) AS cluster_medium
  FROM documents d JOIN {name} c ON d.doc_id = c.doc_id JOIN embeddings v ON d.doc_id = v.vec_id)"""


def both_levels_cte(src: str = "td", name: str = "tl") -> str:
    return f"""
{name} AS (
  SELECT *, 'medium' AS level, cluster_medium AS topic FROM {src}
  UNION ALL
  SELECT *, 'fine' AS level, cluster_fine AS topic FROM {src})"""


def ward_ctes(table: str = "embeddings", key: str = "vec_id", vec: str = "embedding") -> str:
    """``RECURSIVE`` CTEs of Ward's hierarchy: ``leaf`` (id, n, s, node, k) and ``merges`` (low, high, height, size, step).

    Each round merges the pairs that are each other's nearest; clusters are named by their
    smallest leaf.
    """
    return f"""RECURSIVE w AS (
  SELECT 0 AS round, 'c' AS kind, min({key}) AS id, count(*) AS n,
         list_transform(CAST({vec} AS DOUBLE[]), lambda x: x * count(*)) AS s,
         CAST(NULL AS BIGINT) AS other, CAST(NULL AS DOUBLE) AS height
  FROM {table} WHERE {key} IS NOT NULL AND {vec} IS NOT NULL GROUP BY {vec}
  UNION ALL
  (WITH a AS (SELECT round, id, n, s, list_transform(s, lambda x: x / n) AS c FROM w WHERE kind = 'c'),
   d AS (SELECT a.id AS i, b.id AS j, sqrt(2.0 * a.n * b.n / (a.n + b.n)) * list_distance(a.c, b.c) AS h FROM a JOIN a b ON a.id <> b.id),
   f AS (SELECT i, first(j ORDER BY h, least(i, j), greatest(i, j)) AS j, min(h) AS h FROM d GROUP BY i),
   p AS (SELECT x.i AS low, x.j AS high, x.h FROM f x JOIN f y ON y.i = x.j AND y.j = x.i WHERE x.i < x.j),
   g AS (SELECT p.low, p.high, p.h, l.round, l.n + r.n AS n, list_transform(list_zip(l.s, r.s), lambda z: z[1] + z[2]) AS s
         FROM p JOIN a l ON l.id = p.low JOIN a r ON r.id = p.high)
   SELECT round + 1, 'c', id, n, s, NULL, NULL FROM a
   WHERE id NOT IN (SELECT low FROM p UNION ALL SELECT high FROM p) AND (SELECT count(*) FROM a) > 1
   UNION ALL SELECT round + 1, 'c', low, n, s, NULL, NULL FROM g
   UNION ALL SELECT round + 1, 'm', low, n, NULL, high, h FROM g)),
leaf AS (SELECT id, n, s, row_number() OVER (ORDER BY id) - 1 AS node, count(*) OVER () AS k FROM w WHERE round = 0),
merges AS (SELECT id AS low, other AS high, height, n AS size,
                  row_number() OVER (ORDER BY height, n, id, other) - 1 AS step FROM w WHERE kind = 'm')"""
