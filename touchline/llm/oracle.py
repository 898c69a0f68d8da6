"""DuckDB SQL for the queries of this subpackage that SQL can express.

Pairs come from plain joins (every pair of vectors, documents by each shingle
they share, words window by window), groups from a recursive query. The other
queries' columns hold results of their own methods (scores, further labels and
spans, template lengths), ids of tokenizer libraries, or byte and period searches
that have no SQL form of bearable cost; their tests compare with brute force.
"""

from __future__ import annotations

FOLDED = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(edges: str) -> str:
    """CTE ``least`` (id, c): the smallest id reachable over ``edges`` (a, b),
    which hold both directions."""
    return f"""reach AS (
      SELECT a AS id, a AS c FROM (SELECT DISTINCT a FROM {edges})
      UNION
      SELECT e.b, r.c FROM reach r JOIN {edges} e ON e.a = r.id WHERE r.c < e.b),
    least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)"""


OP6 = f"""
WITH RECURSIVE said AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array({FOLDED.format("text")}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                      ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM said),
entries AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (
  SELECT p.doc_id AS a, q.doc_id AS b FROM entries p JOIN entries q ON p.x = q.x AND p.doc_id <> q.doc_id
  WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
{_components("links")}
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.c, s.doc_id) AS component_id, coalesce(l.c, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN least l ON l.id = s.doc_id
"""

OP7 = f"""
WITH RECURSIVE usable AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q ON p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
  WHERE list_cosine_similarity(p.v, q.v) >= 0.9),
{_components("links")},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(l.c, e.vec_id) AS component_id, coalesce(l.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counts n ON n.a = e.vec_id LEFT JOIN least l ON l.id = e.vec_id
"""

_WORDS = "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(FOLDED.format("text"))

OP8 = f"""
WITH items AS MATERIALIZED (SELECT item_id, {_WORDS} AS w FROM benchmark),
asked AS MATERIALIZED (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS x
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(13, len(w)) AS k FROM items WHERE len(w) > 0))),
sizes AS MATERIALIZED (SELECT DISTINCT k FROM asked),
docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
places AS MATERIALIZED (
  SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS x
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes WHERE len(w) >= k)),
hits AS MATERIALIZED (SELECT p.r, p.k, p.i, a.item_id FROM places p JOIN asked a ON a.k = p.k AND a.x = p.x),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, k, i FROM hits)) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS item FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(m.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(m.listed, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN covered c ON c.r = d.r LEFT JOIN named m ON m.r = d.r
"""

ORACLE: dict[str, str] = {"op6_hyperminhash": OP6, "op7_cover_tree": OP7, "op8_winnowing": OP8}
