"""Geometric evidence between items from local features.

Features are rows (key, points array<struct<x,y>>, descriptors array<array<float>>);
producing them from pixels is left to a feature extractor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens.config import Geometry

#: Fewer inliers than this count as this many.
LEAST_INLIERS = 4
FEATURES = "key string, points array<struct<x:float,y:float>>, descriptors array<array<float>>"


def evidence_value(inliers: Column) -> Column:
    """The number that is calibrated: log(1 + inliers), with a floor of inliers that chance reaches too."""
    return F.log1p(F.greatest(inliers, F.lit(LEAST_INLIERS)).cast("double"))


def ratio_matches(a: np.ndarray, b: np.ndarray, ratio: float) -> np.ndarray:
    """(i, j) of the descriptors of ``a`` whose nearest in ``b`` is clearly nearer than the second nearest."""
    if len(a) < 2 or len(b) < 2:
        return np.empty((0, 2), np.int64)
    d = np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)
    two = np.argsort(d, axis=1, kind="stable")[:, :2]
    near, second = (np.sqrt(np.take_along_axis(d, two[:, [c]], 1)[:, 0]) for c in (0, 1))
    ok = near < ratio * second
    return np.column_stack([np.nonzero(ok)[0], two[ok, 0]])


def _levelled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points (try, point, 2) moved to their mean and to a spread of one, and the maps (try, 3, 3) that do so."""
    c, s = x.mean(1, keepdims=True), x.std(axis=(1, 2), keepdims=True)
    s = np.where(s > 0, s, 1.0)
    t = np.zeros((len(x), 3, 3))
    t[:, 0, 0] = t[:, 1, 1] = 1 / s[:, 0, 0]
    t[:, :2, 2] = -c[:, 0] / s[:, 0]
    t[:, 2, 2] = 1
    return (x - c) / s, t


def homographies(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The projective maps (try, 3, 3) from points p to q (try, point, 2) by least squares over four pairs or more; NaN where there is none."""
    (a, ta), (b, tb) = _levelled(p), _levelled(q)
    h = np.concatenate([a, np.ones((*a.shape[:2], 1))], axis=2)
    zero = np.zeros_like(h)
    rows = np.concatenate([np.concatenate([h, zero, -b[:, :, :1] * h], axis=2), np.concatenate([zero, h, -b[:, :, 1:] * h], axis=2)], axis=1)
    m = np.linalg.svd(rows)[2][:, -1].reshape(-1, 3, 3)
    m = np.linalg.solve(tb, m @ ta)
    good = np.isfinite(m).all(axis=(1, 2)) & (np.abs(m[:, 2, 2]) > 1e-12)
    return np.where(good[:, None, None], m, np.nan)


def homography(p: np.ndarray, q: np.ndarray) -> np.ndarray | None:
    """The one map of all the pairs; None where there is none."""
    m = homographies(p[None], q[None])[0]
    return None if np.isnan(m).any() else m


def ransac_inliers(p: np.ndarray, q: np.ndarray, threshold: float, seed: int, tries: int = 500, together: int = 50) -> int:
    """Most pairs of points that one projective map explains within ``threshold``; 0 with fewer than four pairs.

    Maps are solved and tried ``together``, until enough were tried for the
    share of pairs that the best explains.
    """
    there = np.isfinite(p).all(1) & np.isfinite(q).all(1)
    p, q = p[there], q[there]
    if len(p) < 4:
        return 0
    rng, best, needed, at = np.random.default_rng(seed), 0, tries, 0
    to = np.column_stack([p, np.ones(len(p))])
    while at < needed:
        n = min(together, needed - at)
        at += n
        pick = rng.random((n, len(p))).argpartition(3, axis=1)[:, :4] if len(p) > 4 else np.tile(np.arange(4), (1, 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            moved = to @ homographies(p[pick], q[pick]).transpose(0, 2, 1)
            error = np.hypot(*np.moveaxis(moved[:, :, :2] / moved[:, :, 2:] - q, 2, 0))
            found = int((error <= threshold).sum(1).max())
        if found > best:
            best = found
            share = (best / len(p)) ** 4
            needed = at if share >= 1 else min(tries, int(np.ceil(np.log(0.005) / np.log1p(-share))))
        if len(p) == 4:
            break
    return best


def _features(points: pa.Array, descriptors: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Points (n, 2) and descriptors (n, length) of one row, from the flat buffers of the lists; None where it lacks either or has fewer than two."""
    if not points[i].is_valid or not descriptors[i].is_valid:
        return None
    a, z = descriptors.offsets[i].as_py(), descriptors.offsets[i + 1].as_py()
    inner = descriptors.values
    if z - a < 2:
        return None
    flat = inner.values.to_numpy(zero_copy_only=False)[inner.offsets[a].as_py() : inner.offsets[z].as_py()].astype(np.float64).reshape(z - a, -1)
    begin, end = points.offsets[i].as_py(), points.offsets[i + 1].as_py()
    at = np.column_stack([points.values.field(c).to_numpy(zero_copy_only=False)[begin:end] for c in ("x", "y")]).astype(np.float64)
    return at, flat


def inliers(pairs: DataFrame, features: DataFrame, how: Geometry | None = None) -> DataFrame:
    """(a, b, inliers) of the distinct pairs of keys (a, b).

    A pair is computed once in the order of its keys with a seed of that pair,
    so the count is the same in both directions and in every run.  A key
    without features, or with fewer than two, gives 0.
    """
    how = how or Geometry()
    one = pairs.where("a is not null and b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    at_a = features.select(F.col("key").alias("a"), F.col("points").alias("pa"), F.col("descriptors").alias("da"))
    at_b = features.select(F.col("key").alias("b"), F.col("points").alias("pb"), F.col("descriptors").alias("db"))
    both = one.join(at_a, "a", "left").join(at_b, "b", "left").withColumn("seed", F.xxhash64("a", "b").bitwiseAND(F.lit(0x7FFFFFFF)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = {c: batch.column(c) for c in ("a", "b", "pa", "da", "pb", "db", "seed")}
            found = []
            for i in range(batch.num_rows):
                a, b = _features(of["pa"], of["da"], i), _features(of["pb"], of["db"], i)
                m = ratio_matches(a[1], b[1], how.ratio) if a and b else ()
                found.append(ransac_inliers(a[0][m[:, 0]], b[0][m[:, 1]], how.ransac_thresh, of["seed"][i].as_py()) if len(m) >= 4 else 0)
            yield pa.RecordBatch.from_arrays([of["a"], of["b"], pa.array(found, pa.int32())], names=["a", "b", "inliers"])

    return both.mapInArrow(run, "a string, b string, inliers int")


def best_peer(counted: DataFrame) -> DataFrame:
    """(grp, item, inliers, peer) from (grp, item, pos, peer, inliers): most inliers, and the first peer with them; no peer at 0."""
    best = F.max(F.struct("inliers", (-F.col("pos")).alias("first"), "peer"))
    return counted.groupBy("grp", "item").agg(best.alias("b")).select("grp", "item", F.col("b.inliers").alias("inliers"), F.when(F.col("b.inliers") > 0, F.col("b.peer")).alias("peer"))
