import numpy as np
import pyarrow as pa
import pytest

from peerlens.llm.permutation import Pivots, _best, _searched, footrule_closeness, nearest_vectors, similar_photos, usable
from pyspark.sql import functions as F

ROWS = "vec_id long, sha256 string, model string, vec array<float>"


def clusters(seed, n, size, dim=16, noise=0.08):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // size, dim))
    v = np.repeat(centres, size, axis=0) + noise * rng.normal(size=(n // size * size, dim)) * np.linalg.norm(centres, axis=1).mean() / np.sqrt(dim)
    return v.astype(np.float32)


def brute(ids, v, k, least):
    u = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    out = {}
    for i, a in enumerate(ids):
        best = sorted((-s[i, j], ids[j]) for j in np.nonzero(s[i] >= least)[0])[:k]
        out[a] = [b for _, b in best]
    return out


def frame(spark, ids, v):
    return spark.createDataFrame([(int(i), f"s{i}", "dinov2", [float(x) for x in r]) for i, r in zip(ids, v)], ROWS)


def neighbours(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.item, []).append((-r.cos, r.other))
    return {k: [o for _, o in sorted(v)] for k, v in out.items()}


def test_pivots_in_cells():
    """Most of the nearest pivots are in the nearest cells, and rows with too few there look at all."""
    v = clusters(4, 6000, 12)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    pivots = np.ascontiguousarray(v[::3][np.random.default_rng(1).permutation(2000)])
    want, got = _best(v, pivots, 6), Pivots(pivots, 100).nearest(v, 6)
    assert (Pivots(pivots).nearest(v, 6) == want).all() and (np.sort(got, axis=1)[:, 1:] != np.sort(got, axis=1)[:, :-1]).all()
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(want, got)]) > 0.9
    assert (Pivots(pivots[:40], 5).nearest(v[:50], 40) >= 0).all()


@pytest.mark.parametrize(("longest", "flat"), [(2048, 4096), (40, 4)])
def test_recall(spark, longest, flat):
    v = clusters(0, 1500, 12)
    ids = list(range(1, len(v) + 1))
    want = brute(ids, v, 5, 0.9)
    got = neighbours(nearest_vectors(frame(spark, ids, v).repartition(6), "vec_id", "vec", 16, 5, 0.9, longest=longest, flat=flat))
    total = sum(map(len, want.values()))
    hit = sum(len(set(want[i]) & set(got.get(i, []))) for i in ids)
    assert total > 3000 and hit / total >= 0.98
    assert all(len(x) <= 5 for x in got.values())


def test_recall_without_clusters(spark):
    # Here neighbours often share only the last of their pivots; posted under four of six, 0.874 are found.
    v = np.random.default_rng(5).normal(size=(3000, 16)).astype(np.float32)
    ids = list(range(1, len(v) + 1))
    want = brute(ids, v, 5, 0.6)
    got = neighbours(nearest_vectors(frame(spark, ids, v).repartition(6), "vec_id", "vec", 16, 5, 0.6))
    assert sum(len(set(want[i]) & set(got.get(i, []))) for i in ids) / sum(map(len, want.values())) >= 0.91


def test_splitting_a_list_changes_nothing(spark):
    v = clusters(1, 600, 10)
    df = frame(spark, range(len(v)), v)
    one, many = (neighbours(nearest_vectors(df, "vec_id", "vec", 16, 5, 0.9, longest=n, rerank=10_000)) for n in (10_000, 25))
    assert one == many


def test_copies(spark):
    v = np.vstack([np.tile([1, 0, 0, 0], (9, 1)), np.tile([0, 1, 0, 0], (3, 1)), [[0, 0.99, 0.05, 0]], [[0, 0, 0, 1]]]).astype(np.float32)
    got = neighbours(nearest_vectors(frame(spark, range(1, 15), v), "vec_id", "vec", 4, 5, 0.9))
    assert got[1] == [2, 3, 4, 5, 6] and got[9] == [1, 2, 3, 4, 5] and got[3] == [1, 2, 4, 5, 6]
    assert got[10] == [11, 12, 13] and got[13] == [10, 11, 12] and 14 not in got


def test_dirty_rows(spark):
    rows = [(1, "a", "dinov2", [1.0, 0.0]), (1, "a", "dinov2", [1.0, 0.0]), (2, "b", "clip", [1.0, 0.0]), (3, "c", "dinov2", None), (4, "d", "dinov2", [1.0]), (5, "e", "dinov2", [0.0, 0.0]), (6, "f", "dinov2", [float("nan"), 1.0]), (7, "g", "dinov2", [float("inf"), 1.0]), (8, "h", "dinov2", [30.0, 0.1]), (None, "i", "dinov2", [1.0, 0.0]), (9, None, "dinov2", [None, 1.0]), (10, "k", "dinov2", [1e-38, 0.0])]
    df = spark.createDataFrame(rows, ROWS).withColumn("rep", F.lit("clash"))
    assert sorted((r.vec_id_a, r.vec_id_b) for r in similar_photos(df, dim=2).collect()) == [(1, 8), (1, 10), (8, 10)]
    assert [r[0] for r in df.select(usable(F.col("vec"), 2)).collect()].count(True) == 6
    assert similar_photos(df.limit(0), dim=2).count() == 0


def test_many_equal_cosines_go_by_the_smaller_item():
    # One direction at sixty lengths: float32 cosines differ by chance, and by less than that in truth.
    rng = np.random.default_rng(7)
    v = (rng.uniform(0.1, 9, (60, 1)) * rng.normal(size=64)).astype(np.float32)
    n = len(v)
    table = pa.table({
        "rep": pa.array(range(n), pa.int64()), "ids": pa.array([None] * n, pa.list_(pa.int64())), "raw": [r.tobytes() for r in v], "ordered": [np.zeros(1, np.int16).tobytes()] * n,
        "query": [True] * n, "target": [True] * n,
    })
    got = {}
    for r in _searched(5, 0.9, 128, "int16")(table).to_pylist():
        got.setdefault(r["rep"], set()).add((-round(r["cos"], 12), r["other"]))
    assert all([j for _, j in sorted(got[i])][:5] == [j for j in range(6) if j != i][:5] for i in range(n))


def test_footrule():
    order = np.array([[1, 2, 3], [2, 1, 3], [4, 5, 6], [3, 2, 1]])
    m = order.shape[1]

    def distance(a, b):
        place = lambda x, p: list(x).index(p) if p in x else m
        return sum(abs(place(a, p) - place(b, p)) for p in {*a, *b})

    close = footrule_closeness(order)
    for i in range(4):
        for j in range(4):
            assert m * (m + 1) - 2 * close[i, j] == distance(order[i], order[j])


def test_nearest_pivots():
    rng = np.random.default_rng(2)
    p, v = rng.normal(size=(30, 5)).astype(np.float32), rng.normal(size=(50, 5)).astype(np.float32)
    assert (_best(v, p, 4) == np.argsort(-(v @ p.T), axis=1, kind="stable")[:, :4]).all()
    assert _best(v, p[:3], 3).shape == (50, 3)
