"""DuckDB SQL over whole tables for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["p1_found"] = """
WITH newest AS (
  SELECT outlet, file_name, suspicion, z FROM image_evals
  WHERE outlet IS NOT NULL AND file_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY outlet, file_name ORDER BY evaluated_at DESC NULLS LAST, eval_id DESC) = 1
), lists AS (
  SELECT outlet AS outlet_id, 'evals' AS list_name, -suspicion AS a, CASE WHEN z IS NULL OR isnan(z) THEN 0 ELSE z END AS b, file_name
  FROM newest WHERE suspicion IS NOT NULL AND NOT isnan(suspicion)
  UNION ALL
  SELECT outlet_id, 'flagged', -max(e.suspicion_score), 0, e.file_name
  FROM (SELECT outlet_id, unnest(flagged_images) AS e FROM results)
  WHERE outlet_id IS NOT NULL AND e.file_name IS NOT NULL AND e.suspicion_score IS NOT NULL AND NOT isnan(e.suspicion_score)
  GROUP BY outlet_id, e.file_name
  UNION ALL
  SELECT outlet_id, 'ranking', min(pos), 0, file_name
  FROM (SELECT outlet_id, unnest(ranking) AS file_name, generate_subscripts(ranking, 1) AS pos FROM results)
  WHERE outlet_id IS NOT NULL AND file_name IS NOT NULL
  GROUP BY outlet_id, file_name
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY outlet_id, list_name ORDER BY a, b, encode(file_name)) AS r FROM lists
)
SELECT outlet_id, list_name, CAST(r AS INTEGER) AS rank_no, file_name FROM ranked WHERE r <= 5
"""

#: One row per record of ``images``: its lowest batch counts; trimmed lower-case sha256; the dhash as bits where it can be near another.
_RECORDS = r"""
records AS (
  SELECT image_id, batch_no, sha, bits FROM (
    SELECT image_id, batch_no, lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')) AS sha,
      CASE WHEN octet_length(dhash) = 32 AND hex(dhash) <> repeat('0', 64) THEN dhash::BIT END AS bits
    FROM images WHERE image_id IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY batch_no, sha DESC NULLS LAST, bits DESC NULLS LAST) = 1
)"""

ORACLE["p2_found"] = rf"""
WITH RECURSIVE {_RECORDS}, node AS (
  SELECT sha, min(image_id) AS node FROM records WHERE sha IS NOT NULL GROUP BY sha
), pair AS (
  SELECT a.node AS u, b.node AS v
  FROM (SELECT lower(regexp_replace(sha256_a, '^\s+|\s+$', '', 'g')) AS sa, lower(regexp_replace(sha256_b, '^\s+|\s+$', '', 'g')) AS sb
        FROM match_pairs WHERE lower(regexp_replace(verdict, '^\s+|\s+$', '', 'g')) = 'match') m
  JOIN node a ON a.sha = m.sa JOIN node b ON b.sha = m.sb WHERE a.node <> b.node
), edge AS (
  SELECT u, v FROM pair UNION SELECT v, u FROM pair
), reach AS (
  SELECT u AS node, u AS seen FROM edge
  UNION SELECT r.node, e.v FROM reach r JOIN edge e ON e.u = r.seen
), label AS (
  SELECT node, min(seen) AS group_id FROM reach GROUP BY node
), labelled AS (
  SELECT coalesce(l.group_id, n.node) AS group_id, r.image_id
  FROM records r JOIN node n ON n.sha = r.sha LEFT JOIN label l ON l.node = n.node
)
SELECT group_id, image_id FROM labelled
WHERE group_id IN (SELECT group_id FROM labelled GROUP BY group_id HAVING count(*) > 1)
"""

#: All pairs of vectors; the query is an index search, so on large tables it may miss a few of these.
ORACLE["p3_found"] = """
WITH v AS (
  SELECT vec_id, min(CAST(vec AS DOUBLE[])) AS v FROM image_vectors
  WHERE model = 'dinov2' AND len(vec) = 64 AND len(list_filter(vec, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(vec, lambda x: x <> 0)) > 0
  GROUP BY vec_id
), pair AS (
  SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.v, b.v) AS cos FROM v a JOIN v b ON a.vec_id <> b.vec_id
), best AS (
  SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY round(cos, 12) DESC, b) AS r FROM pair WHERE cos >= 0.90
)
SELECT DISTINCT least(a, b) AS vec_id_a, greatest(a, b) AS vec_id_b FROM best WHERE r <= 5
"""

ORACLE["p5_found"] = rf"""
WITH {_RECORDS}, near AS (
  SELECT a.image_id AS a, b.image_id AS b
  FROM (SELECT * FROM records WHERE bits IS NOT NULL) a JOIN (SELECT * FROM records WHERE bits IS NOT NULL) b
    ON a.image_id < b.image_id AND bit_count(xor(a.bits, b.bits)) <= 8
  WHERE a.sha IS NULL OR b.sha IS NULL OR a.sha <> b.sha
)
SELECT a AS image_id_a, b AS image_id_b FROM near
"""


def _by_batch(last: int) -> str:
    """Batches 1 to ``last`` in their order: a record is a case of its batch or accepted with it."""
    steps = ["acc0 AS MATERIALIZED (SELECT image_id FROM records WHERE batch_no = 0)"]
    for b in range(1, last + 1):
        steps.append(
            f"case{b} AS MATERIALIZED (SELECT min(l.a) AS earlier_id, l.b AS image_id FROM link l JOIN acc{b - 1} ON acc{b - 1}.image_id = l.a WHERE l.batch_b = {b} GROUP BY l.b)"
        )
        steps.append(
            f"acc{b} AS MATERIALIZED (SELECT image_id FROM acc{b - 1} UNION ALL SELECT image_id FROM records WHERE batch_no = {b} AND image_id NOT IN (SELECT image_id FROM case{b}))"
        )
    return ",\n".join(steps) + "\n" + "\nUNION ALL ".join(f"SELECT earlier_id, image_id FROM case{b}" for b in range(1, last + 1))


#: batch_no runs from 0 to 8 in this data.
ORACLE["p4_found"] = rf"""
WITH {_RECORDS}, link AS MATERIALIZED (
  SELECT a.image_id AS a, b.image_id AS b, b.batch_no AS batch_b FROM records a JOIN records b ON a.sha = b.sha AND a.batch_no < b.batch_no
  UNION
  SELECT a.image_id, b.image_id, b.batch_no
  FROM (SELECT * FROM records WHERE bits IS NOT NULL) a JOIN (SELECT * FROM records WHERE bits IS NOT NULL AND batch_no > 0) b
    ON a.batch_no < b.batch_no AND bit_count(xor(a.bits, b.bits)) <= 8
),
{_by_batch(8)}
"""
