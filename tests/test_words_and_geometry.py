import numpy as np
from pyspark.sql import functions as F

from peerlens.config import Geometry
from peerlens.functions import text
from peerlens.functions.hashing import dhash, hamming, phash
from peerlens.functions.vectors import softmax, unit
from peerlens.operators import explain, geometry

TEXTS = "a array<struct<text:string,conf:double>>, b array<struct<text:string,conf:double>>"


def test_tokens_and_clauses(spark):
    data = [([("Rocket-Agent point", 0.9), ("AGENT x", 0.5), ("unsure", 0.1)], [("point sale", 0.4)]), ([], [("point", 0.9)]), ([("point", 0.9)], []), ([], []), (None, None)]
    df = spark.createDataFrame(data, TEXTS)
    assert df.select(text.tokens(F.col("a"))).first()[0] == ["agent", "point", "rocket"]
    got = [r[0] for r in df.select(explain.text_clause(F.col("a"), F.col("b"))).collect()]
    assert "shares 1/3 tokens" in got[0] and got[1].startswith("No readable signage text") and "no counterpart" in got[2] and got[3] is None and got[4] is None


def test_snippet(spark):
    df = spark.createDataFrame([([("b", 0.5), ("a", 0.9), ("c", 0.5), ("d", 0.1)], None), ([("x" * 80, 0.5)], None)], TEXTS)
    got = [r[0] for r in df.select(text.snippet(F.col("a"))).collect()]
    assert got[0] == "a | b | c" and len(got[1]) == 60 and got[1].endswith("…")


def test_majority_without_oneself(spark):
    rows = spark.createDataFrame([("g", 1, "a"), ("g", 2, "a"), ("g", 3, "b"), ("g", 4, "b"), ("h", 1, "z")], "grp string, item int, label string")
    got = {(r.grp, r["item"]): (r.label, r.k, r.n) for r in explain.majority_of_others(rows).collect()}
    assert got == {("g", 1): ("b", 2, 3), ("g", 2): ("b", 2, 3), ("g", 3): ("a", 2, 3), ("g", 4): ("a", 2, 3)}


def test_scene_and_brand(spark):
    df = spark.createDataFrame([("s", "t", 3, 4, "x", 0.9, "y"), ("s", "s", 3, 4, "none", 0.9, "y"), (None, "s", 3, 4, "x", 0.1, "y")], "o string, m string, k int, n int, b string, p double, bm string")
    got = df.select(explain.scene_clause(F.col("o"), F.col("m"), F.col("k"), F.col("n")).alias("s"), explain.brand_clause(F.col("b"), F.col("p"), F.col("bm")).alias("b")).collect()
    assert "3/4 peers" in got[0].s and got[1].s.startswith("Same scene") and got[2].s is None
    assert got[0].b == "Telecom branding reads 'x' vs 'y' on peers." and got[1].b is None and got[2].b is None


def test_softmax_and_unit(spark):
    df = spark.createDataFrame([([1000.0, 1000.0],), ([0.0, 0.0],), ([3.0, 4.0],), ([float("nan"), 1.0],), (None,)], "v array<double>")
    got = df.select(softmax(F.col("v")).alias("s"), unit(F.col("v")).alias("u")).collect()
    assert got[0].s == [0.5, 0.5] and got[1].u is None and got[2].u == [0.6, 0.8] and got[3].u is None and got[4].u is None


def test_hashes(spark):
    rng = np.random.default_rng(0)
    image = rng.integers(0, 255, (64, 48)).astype(float)
    ramp = np.tile(np.arange(64.0), (64, 1))
    assert dhash(ramp) == b"\xff" * 32 and dhash(ramp[:, ::-1]) == b"\0" * 32
    v = phash(image)
    assert abs(v @ v - 1) < 1e-12 and phash(image) @ phash(255 - image) < -0.9
    df = spark.createDataFrame([(b"\xff" * 32, b"\0" * 32), (b"\x80" + b"\0" * 31, b"\x80" + b"\0" * 31), (None, b"\0" * 32)], "a binary, b binary")
    assert [r[0] for r in df.select(hamming(F.col("a"), F.col("b"))).collect()] == [256, 0, None]


def test_ransac():
    rng = np.random.default_rng(1)
    p = rng.uniform(0, 500, (60, 2))
    m = np.array([[0.9, 0.1, 20], [-0.1, 1.1, 5], [1e-4, 0, 1]])
    q = np.column_stack([p, np.ones(60)]) @ m.T
    q = q[:, :2] / q[:, 2:]
    q[40:] = rng.uniform(0, 500, (20, 2))
    n = geometry.ransac_inliers(p, q, 5.0, 3)
    assert 40 <= n <= 43 and n == geometry.ransac_inliers(p, q, 5.0, 3)
    assert geometry.ransac_inliers(p[:3], q[:3], 5.0, 3) == 0


def test_inliers_and_best_peer(spark):
    rng = np.random.default_rng(2)
    pts, des = rng.uniform(0, 300, (30, 2)), rng.normal(size=(30, 16))
    row = lambda k, p, d: (k, [{"x": float(x), "y": float(y)} for x, y in p], [[float(v) for v in x] for x in d])
    features = spark.createDataFrame([row("a", pts, des), row("b", pts + 10, des), row("c", pts, rng.normal(size=(30, 16))), ("d", [], [])], geometry.FEATURES)
    pairs = spark.createDataFrame([("b", "a"), ("a", "b"), ("a", "c"), ("a", "d"), ("a", "none"), (None, "a")], "a string, b string")
    got = {(r.a, r.b): r.inliers for r in geometry.inliers(pairs, features, Geometry()).collect()}
    assert got["a", "b"] == 30 and got["a", "c"] < 8 and got["a", "d"] == 0 and got["a", "none"] == 0 and len(got) == 4
    counted = spark.createDataFrame([("g", "x", 1, "p", 5), ("g", "x", 2, "q", 9), ("g", "x", 3, "r", 9), ("g", "y", 1, "p", 0)], "grp string, item string, pos int, peer string, inliers int")
    best = {r["item"]: (r.inliers, r.peer) for r in geometry.best_peer(counted).collect()}
    assert best == {"x": (9, "q"), "y": (0, None)}
    values = spark.createDataFrame([(0,), (4,), (5,)], "n int").select(geometry.evidence_value(F.col("n"))).collect()
    assert values[0] == values[1] and values[1][0] < values[2][0]


def test_zero_shot(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id int, vec array<double>")
    got = {r.id: (r.label, round(r.p, 3)) for r in explain.zero_shot(df, "id", [("east", [1.0, 0.0]), ("north", [0.0, 1.0])], 10.0).collect()}
    assert got == {1: ("east", 1.0), 2: ("north", 1.0)}
