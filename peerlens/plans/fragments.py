"""Common table expressions that the checking SQL is put together from."""

from __future__ import annotations

#: Items and vectors of the embeddings table: its label is the group.
EMB = "items AS (SELECT CAST(label AS VARCHAR) AS grp, vec_id AS item, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"

PAIR = """pair AS (
  SELECT a.grp, a.item AS i, b.item AS j, list_inner_product(a.vec, b.vec) AS cos
  FROM items a JOIN items b ON a.grp = b.grp AND a.item <> b.item)"""

CONSENSUS = """cons AS (
  SELECT i.grp, i.item, count(p.cos) AS n_peers, CASE WHEN count(p.cos) < 3 THEN avg(p.cos) ELSE median(p.cos) END AS s
  FROM items i LEFT JOIN pair p ON p.grp = i.grp AND p.i = i.item GROUP BY i.grp, i.item)"""

SCORES = """med AS (SELECT grp, median(s) AS median_s, count(*) AS n_scored FROM cons GROUP BY grp),
mads AS (SELECT c.grp, median(abs(c.s - m.median_s)) AS mad FROM cons c JOIN med m ON m.grp = c.grp GROUP BY c.grp),
scores AS (
  SELECT c.grp, c.item, c.n_peers, c.s, m.median_s, m.n_scored, d.mad, 0.6745 * (c.s - m.median_s) / greatest(d.mad, 0.01) AS z
  FROM cons c JOIN med m ON m.grp = c.grp JOIN mads d ON d.grp = c.grp)"""

#: Each group's donor: the next on the ring of hashes.
DONORS = """ring AS (
  SELECT grp, row_number() OVER (ORDER BY sha256('0|donor|' || grp), grp) AS r, count(*) OVER () AS n
  FROM (SELECT DISTINCT grp FROM scores WHERE n_scored >= 2)),
donor AS (SELECT a.grp, b.grp AS donor FROM ring a JOIN ring b ON b.r = a.r % a.n + 1)"""

SAMPLES = """foreign_s AS (
  SELECT i.grp, i.item, CASE WHEN count(*) < 3 THEN avg(list_inner_product(i.vec, o.vec)) ELSE median(list_inner_product(i.vec, o.vec)) END AS s
  FROM items i JOIN donor d ON d.grp = i.grp JOIN items o ON o.grp = d.donor GROUP BY i.grp, i.item),
sample AS (
  SELECT 'pos' AS side, s AS x FROM scores WHERE n_scored >= 2 AND s IS NOT NULL AND z >= -2.5
  UNION ALL SELECT 'neg', s FROM foreign_s)"""

FIT = """side AS (SELECT side, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS bw FROM sample GROUP BY side),
span AS (SELECT min(x) AS lo, max(x) AS hi FROM sample)"""


def density(points: str, name: str = "lr", x: str = "x") -> str:
    """CTEs: (x, log_lr, p) of the distinct values ``x`` of the table ``points``, over all sample points; prior 0.05."""
    return f"""{name}_at AS (SELECT DISTINCT p.{x} AS x, least(greatest(p.{x}, s.lo), s.hi) AS at FROM {points} p, span s WHERE p.{x} IS NOT NULL),
{name}_den AS (
  SELECT a.x, m.side, avg(exp(-0.5 * pow((a.at - m.x) / d.bw, 2))) / (any_value(d.bw) * sqrt(2 * pi())) AS f
  FROM {name}_at a, sample m JOIN side d ON d.side = m.side GROUP BY a.x, m.side),
{name} AS (
  SELECT x, log_lr, 1 / (1 + exp(-(ln(0.05 / 0.95) + log_lr))) AS p FROM (
    SELECT x, least(greatest(ln(max(f) FILTER (WHERE side = 'neg') + 1e-300) - ln(max(f) FILTER (WHERE side = 'pos') + 1e-300), -12), 12) AS log_lr
    FROM {name}_den GROUP BY x))"""


GRID = "grid AS (SELECT s.lo + (s.hi - s.lo) * i / 2000.0::DOUBLE AS x FROM span s, range(2001) t(i))"


def floors(ready: str = "grid_lr") -> str:
    return f"""floors AS (
  SELECT coalesce((SELECT max(x) FROM {ready} WHERE p >= 0.3), s.lo) AS floor, coalesce((SELECT max(x) FROM {ready} WHERE p >= 0.05), s.lo) AS support_floor FROM span s)"""


#: Items of the images table: one row per outlet and file.
IMAGES = r"""pics AS (
  SELECT outlet AS grp, file_name AS item, lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')) AS sha, coalesce(readable, false) AS readable,
    CASE WHEN octet_length(dhash) = 32 AND hex(dhash) <> repeat('0', 64) THEN dhash::BIT END AS bits
  FROM images WHERE outlet IS NOT NULL AND file_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY outlet, file_name ORDER BY coalesce(readable, false) DESC, lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')) DESC NULLS LAST, dhash DESC NULLS LAST) = 1)"""

COPIES = """link AS (
  SELECT a.grp, a.item AS u, b.item AS v FROM pics a JOIN pics b ON a.grp = b.grp AND a.item <> b.item AND a.sha = b.sha
  UNION SELECT a.grp, a.item, b.item FROM (SELECT * FROM pics WHERE bits IS NOT NULL) a JOIN (SELECT * FROM pics WHERE bits IS NOT NULL) b
    ON a.grp = b.grp AND a.item <> b.item AND bit_count(xor(a.bits, b.bits)) <= 8),
reach AS (
  SELECT grp, u AS item, u AS seen FROM link UNION SELECT r.grp, r.item, l.v FROM reach r JOIN link l ON l.grp = r.grp AND l.u = r.seen),
roots AS (SELECT p.grp, p.item, p.readable, coalesce(min(r.seen), p.item) AS root FROM pics p LEFT JOIN reach r ON r.grp = p.grp AND r.item = p.item GROUP BY p.grp, p.item, p.readable),
copies AS (
  SELECT grp, item, root, first_value(item) OVER (PARTITION BY grp, root ORDER BY NOT readable, item) AS rep, count(*) OVER (PARTITION BY grp, root) AS size FROM roots)"""

#: Usable vectors by content, of length one.
VECTORS = r"""norms AS (
  SELECT lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')) AS sha, CAST(vec AS DOUBLE[]) AS v, sqrt(list_inner_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[]))) AS n
  FROM image_vectors WHERE model = 'dinov2' AND len(vec) = 64 AND sha256 IS NOT NULL),
vectors AS (SELECT sha, min(list_transform(v, lambda x: x / n)) AS vec FROM norms WHERE n > 0 AND isfinite(n) GROUP BY sha)"""

#: The scored items of the images: readable representatives with a vector.
REPS = "items AS (SELECT p.grp, p.item, p.sha, v.vec FROM pics p JOIN copies c ON c.grp = p.grp AND c.item = p.item AND c.rep = p.item JOIN vectors v ON v.sha = p.sha WHERE p.readable)"

SCORED = ",\n".join([PAIR, CONSENSUS, SCORES])
CALIBRATED = ",\n".join([SCORED, DONORS, SAMPLES, FIT])

#: Candidates with their subgroups, posterior and flag.
GATED = ",\n".join([
    density("scores", "lr", "s"), GRID, density("grid", "grid_lr"), floors(),
    """cand AS (
  SELECT sc.*, l.p AS p0, CASE WHEN sc.n_scored >= 3 THEN coalesce(sc.z < -2.5, false) OR coalesce(l.p >= 0.5, false) ELSE sc.n_scored = 2 END AS candidate
  FROM scores sc LEFT JOIN lr l ON l.x = sc.s),
sub AS (
  SELECT c.grp, c.item, count(*) + 1 AS size, median(p.cos) AS s_sub, bool_or(coalesce(o.s >= f.support_floor, false)) AS anchored
  FROM cand c, floors f, pair p, scores o
  WHERE c.candidate AND c.n_scored >= 3 AND p.grp = c.grp AND p.i = c.item AND p.cos >= f.support_floor AND o.grp = p.grp AND o.item = p.j
  GROUP BY c.grp, c.item HAVING count(*) + 1 >= 3)""",
    density("sub", "sub_lr", "s_sub"),
    """gated AS (
  SELECT c.*, u.size AS sub_size, u.s_sub AS sub_s, u.anchored AS sub_anchored, CASE WHEN u.anchored THEN c.p0 * q.p ELSE c.p0 END AS p
  FROM cand c LEFT JOIN sub u ON u.grp = c.grp AND u.item = c.item LEFT JOIN sub_lr q ON q.x = u.s_sub),
flags AS (SELECT *, coalesce(candidate AND p >= 0.3, false) AS flagged, CASE WHEN coalesce(candidate AND p >= 0.3, false) AND n_scored = 2 THEN 'pair' ELSE 'scored' END AS kind FROM gated)""",
])

CROSS = """places AS (SELECT sha, grp, min(item) AS first_item FROM pics WHERE sha IS NOT NULL GROUP BY sha, grp),
crossed AS (
  SELECT p.grp, p.item, min({'g': o.grp, 'i': o.first_item}) AS other
  FROM pics p JOIN places o ON o.sha = p.sha AND o.grp <> p.grp GROUP BY p.grp, p.item)"""

DECIDED = """decided AS (
  SELECT p.grp, p.item,
    CASE WHEN NOT p.readable THEN 'unreadable' WHEN x.other IS NOT NULL THEN 'cross_duplicate' WHEN c.rep <> p.item THEN 'duplicate' ELSE coalesce(f.kind, 'scored') END AS kind,
    CASE WHEN NOT p.readable THEN 0.5 WHEN x.other IS NOT NULL THEN greatest(CASE WHEN c.rep <> p.item THEN greatest(0.3, r.p) ELSE f.p END, 0.9)
      WHEN c.rep <> p.item THEN greatest(0.3, r.p) ELSE f.p END AS suspicion,
    NOT p.readable OR x.other IS NOT NULL OR c.rep <> p.item OR coalesce(f.flagged, false) AS flagged,
    coalesce(f.candidate, false) AS candidate, f.s, f.z, f.median_s, f.n_scored, f.sub_size, f.sub_s, f.sub_anchored,
    CASE WHEN p.readable AND c.rep <> p.item THEN c.rep END AS dup_of, CASE WHEN p.readable AND c.rep <> p.item THEN coalesce(r.flagged, false) END AS rep_flagged,
    CASE WHEN p.readable THEN x.other.g END AS other_grp, CASE WHEN p.readable THEN x.other.i END AS other_item
  FROM pics p JOIN copies c ON c.grp = p.grp AND c.item = p.item LEFT JOIN flags f ON f.grp = p.grp AND f.item = p.item
  LEFT JOIN flags r ON r.grp = p.grp AND r.item = c.rep LEFT JOIN crossed x ON x.grp = p.grp AND x.item = p.item),
ranked AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY suspicion DESC NULLS LAST, coalesce(z, 0), encode(item)) AS rank FROM decided)"""

#: Everything up to the ranked decision of every image.
AUDIT = "WITH RECURSIVE " + ",\n".join([IMAGES, COPIES, VECTORS, REPS, CALIBRATED, GATED, CROSS, DECIDED])
#: Up to the scores of the images.
IMAGE_SCORES = "WITH RECURSIVE " + ",\n".join([IMAGES, COPIES, VECTORS, REPS, SCORED])
