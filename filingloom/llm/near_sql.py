"""Similar documents in SQL, for tables of a size that a second engine can hold."""

from __future__ import annotations

import string


def near_copies_sql(k: int, num: int) -> str:
    """Common table expressions that end with `found`: doc_id, n_shingles, node, component_id.

    Pairs that share one of the rarest shingles, of which each set lists as many as a partner at num per cent can lack and one
    more, are compared on their whole sets; components are the closure of the links. Ids are taken to be unique.
    """
    run = " || ' ' || ".join(["w", *[f"lead(w, {j}) OVER by_place" for j in range(1, k)]])
    return f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) >= {k}),
runs AS (SELECT doc_id, {run} AS t FROM placed WINDOW by_place AS (PARTITION BY doc_id ORDER BY i)),
whole AS (SELECT doc_id, t FROM runs WHERE t IS NOT NULL UNION SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND {k} - 1),
sets AS (SELECT doc_id, coalesce(s, []) AS s FROM documents LEFT JOIN (SELECT doc_id, list(t ORDER BY t) AS s FROM whole GROUP BY doc_id) USING (doc_id)),
nodes AS (SELECT min(doc_id) AS node, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT node, n, unnest(s) AS t FROM nodes),
often AS (SELECT t, count(*) AS df FROM tokens GROUP BY t),
listed AS (
    SELECT node, n, t FROM (SELECT node, n, t, row_number() OVER (PARTITION BY node ORDER BY df, t) AS r FROM tokens JOIN often USING (t))
    WHERE r <= n - ({num} * n + 99) // 100 + 1),
pairs AS (
    SELECT DISTINCT a.node AS a, b.node AS b FROM listed a JOIN listed b ON a.t = b.t AND a.node < b.node AND 100 * least(a.n, b.n) >= {num} * greatest(a.n, b.n)),
links AS (
    SELECT a, b FROM (SELECT a, b, x.n + y.n AS total, len(list_intersect(x.s, y.s)) AS common
        FROM pairs JOIN nodes x ON x.node = a JOIN nodes y ON y.node = b) WHERE 100 * common >= {num} * (total - common)),
steps AS (SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT u, v FROM steps UNION SELECT r.u, s.v FROM reached r JOIN steps s ON r.v = s.u),
least_of AS (SELECT u AS node, min(least(u, v)) AS component_id FROM reached GROUP BY u),
found AS (
    SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(nodes.node, sets.doc_id) AS node, coalesce(component_id, nodes.node, sets.doc_id) AS component_id
    FROM sets LEFT JOIN nodes ON sets.s = nodes.s AND len(sets.s) > 0 LEFT JOIN least_of ON nodes.node = least_of.node)
"""
