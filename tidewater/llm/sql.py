"""SQL forms (DuckDB) of the training-data queries that SQL can express."""

from __future__ import annotations

_WHOLE = """SELECT vec_id, label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

HARD_NEGATIVES = f"""
WITH whole AS ({_WHOLE}),
kept AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM whole
  WHERE vec_id IS NOT NULL AND label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
    CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
  FROM kept a JOIN kept r ON a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


def vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Every round as a step of its own: all parts against all entries."""
    steps = f"""
WITH whole AS ({_WHOLE}),
kept AS (SELECT *, row_number() OVER () AS row_no, (SELECT CAST(ceil(max(len(v)) / {parts}) AS BIGINT) FROM whole) AS w
  FROM whole),
pieces AS (SELECT row_no, p, list_slice(v, p * w + 1, (p + 1) * w) AS x FROM kept, range({parts}) AS t(p)),
start AS (SELECT row_no, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM kept WHERE vec_id IS NOT NULL
  QUALIFY k < {entries}),
book0 AS (SELECT p, k, x AS e FROM start JOIN pieces USING (row_no))"""
    for i in range(rounds + 1):
        steps += f""",
near{i} AS (
  SELECT row_no, p, min(struct_pack(d := d, k := k)) AS best
  FROM (SELECT row_no, pieces.p, k, list_sum(list_transform(list_zip(x, e), lambda c: (c[1] - c[2]) * (c[1] - c[2]))) AS d
        FROM pieces JOIN book{i} ON pieces.p = book{i}.p)
  GROUP BY row_no, p)"""
        if i < rounds:
            steps += f""",
mean{i} AS (
  SELECT p, k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS e
  FROM (SELECT p, k, pos, sum(c) AS s, count(*) AS n
        FROM (SELECT pieces.p, best.k AS k, unnest(x) AS c, generate_subscripts(x, 1) AS pos
              FROM pieces JOIN near{i} USING (row_no, p))
        GROUP BY p, k, pos)
  GROUP BY p, k),
book{i + 1} AS (SELECT p, k, coalesce(m.e, b.e) AS e FROM book{i} b LEFT JOIN mean{i} m USING (p, k))"""
    return steps + f""",
coded AS (
  SELECT row_no, string_agg(format('{{:02x}}', best.k), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY row_no)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (row_no)
"""
