import numpy as np
import pytest
from pyspark.sql import functions as F

from peerlens.config import Config
from peerlens.operators import calibrate, decide, explain, records
from peerlens.operators import consensus as c
from peerlens.operators.ranking import ranked, running_totals, suspicion_order
from peerlens.operators.scratch import Scratch
from tests.groups import axis, between, fan

ITEMS = "grp string, item string, sha string, readable boolean, bits binary"
CFG = Config()


@pytest.fixture(scope="module")
def ratio(spark):
    rng = np.random.default_rng(5)
    data = [("pos", float(x)) for x in rng.normal(0.75, 0.05, 500)] + [("neg", float(x)) for x in rng.normal(0.35, 0.1, 500)]
    return calibrate.fit(spark.createDataFrame(data, "side string, x double"), CFG.gate.prior_outlier_rate)


def decided(spark, ratio, groups, extra=(), cfg=CFG):
    """Decisions on groups of vectors (name -> array), with further items (grp, item, sha, readable) that have no vector of their own."""
    items = [(g, f"i{k:02d}", f"{g}{k}", True, None) for g, vs in groups.items() for k in range(len(vs))] + [(*e, None) for e in extra]
    vectors = [(f"{g}{k}", [float(x) for x in v]) for g, vs in groups.items() for k, v in enumerate(vs)]
    scratch = Scratch(spark, "t")
    ready = decide.prepare(spark.createDataFrame(items, ITEMS), spark.createDataFrame(vectors, "sha string, vec array<double>"), cfg, scratch)
    gated = decide.gate(ready.reps, ready.scores, ratio, cfg, scratch)
    rows = ranked(decide.resolve(ready, gated, cfg), "grp", suspicion_order(), scratch=scratch).collect()
    return {(r.grp, r["item"]): r for r in rows}, ready


def test_foreign_cluster_is_flagged(spark, ratio):
    got, ready = decided(spark, ratio, {"g": np.vstack([fan(axis(0), 10, 0.94, 8), fan(axis(1), 4, 0.94, 24)])})
    for i in range(14):
        r = got["g", f"i{i:02d}"]
        assert r.flagged == (i >= 10)
        if i >= 10:
            assert r.sub_size == 4 and r.sub_anchored is False and r.sub_s == pytest.approx(0.94**2)
    assert not c.folders(ready.scores).first().review


def test_bridged_subgroup_is_spared(spark, ratio):
    u, w = axis(0), between(axis(0), axis(1), 0.55)
    middle = (u + w) / np.sqrt(2 + 2 * 0.55)
    got, _ = decided(spark, ratio, {"g": np.vstack([fan(u, 10, 0.97, 8), fan(w, 3, 0.97, 24), fan(middle, 2, 0.97, 32)])})
    for i in (10, 11, 12):
        r = got["g", f"i{i:02d}"]
        assert r.candidate and r.sub_anchored and not r.flagged


def test_incoherent_group_goes_to_review(spark, ratio):
    vs = np.vstack([fan(axis(k), 3, 0.94, 8 + 4 * k) for k in range(4)])
    got, ready = decided(spark, ratio, {"g": vs, "h": fan(axis(5), 10, 0.94, 40)})
    review = {r.grp: r.review for r in c.folders(ready.scores).collect()}
    assert review == {"g": True, "h": False}
    assert all(got["g", f"i{i:02d}"].flagged for i in range(12)) and not any(got["h", f"i{i:02d}"].flagged for i in range(10))


def test_small_groups_and_policies(spark, ratio):
    groups = {"one": axis(0)[None], "pair": np.stack([axis(0), axis(1)]), "home": fan(axis(0), 6, 0.94, 8)}
    extra = [
        ("one", "copy", "one0", True), ("home", "copy", "home1", True), ("home", "broken", "x", False), ("home", "brokencopy", "x", False),
        ("home", "there", "shared", True), ("pair", "here", "shared", True), ("home", "there2", "shared", True),
    ]
    got, _ = decided(spark, ratio, groups, extra)
    # The representative is the first by name.
    assert got["one", "copy"].kind == "scored" and got["one", "copy"].suspicion is None and not got["one", "copy"].flagged
    dup = got["one", "i00"]
    assert dup.kind == "duplicate" and dup.suspicion == 0.3 and dup.flagged
    assert got["pair", "i00"].kind == got["pair", "i01"].kind == "pair" and got["pair", "i00"].flagged
    assert got["home", "broken"].kind == got["home", "brokencopy"].kind == "unreadable" and got["home", "brokencopy"].suspicion == 0.5
    for k in (("home", "there"), ("pair", "here"), ("home", "there2")):
        assert got[k].kind == "cross_duplicate" and got[k].suspicion >= 0.9
    assert got["pair", "here"].other_grp == "home" and got["home", "there"].other_item == "here"


def test_ranking_order_and_ties(spark):
    data = [("g", "b", 0.5, 1.0), ("g", "a", 0.5, 1.0), ("g", "c", 0.5, -1.0), ("g", "d", 0.9, None), ("g", "e", None, None), ("h", "z", None, None)]
    rows = ranked(spark.createDataFrame(data, "grp string, item string, suspicion double, z double").repartition(5), "grp", suspicion_order()).collect()
    order = {(r.grp, r["rank"]): r["item"] for r in rows}
    assert [order["g", i] for i in range(1, 6)] == ["d", "c", "a", "b", "e"] and order["h", 1] == "z"


def test_ranking_of_a_large_group_and_totals(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4900, "big").otherwise("small").alias("grp"), F.col("id").alias("item"), (F.col("id") * 7919 % 5000).alias("x"))
    rows = ranked(df, "grp", [F.col("x").asc()]).collect()
    for g, n in (("big", 4900), ("small", 100)):
        mine = sorted((r["rank"], r.x) for r in rows if r.grp == g)
        assert [k for k, _ in mine] == list(range(1, n + 1)) and [x for _, x in mine] == sorted(x for _, x in mine)
    sums = running_totals(df, ["grp"], [F.col("x").asc()], {"t": F.col("x")}).where("grp = 'big'").orderBy("x").collect()
    assert [r.t for r in sums] == np.cumsum([r.x for r in sums]).tolist()


def test_reasons(spark, ratio):
    schema = "kind string, dup_of string, rep_flagged boolean, other_grp string, other_item string, s double, z double, median_s double, geom_inliers int, geom_peer string, geom_log_lr double, sub_size int, sub_s double, sub_anchored boolean"
    none = (None,) * 6
    data = [
        ("unreadable", None, None, None, None, None, None, None, *none), ("duplicate", "a.jpg", True, None, None, None, None, None, *none),
        ("cross_duplicate", None, None, "o", "f", None, None, None, *none), ("pair", None, None, None, None, 0.1, None, None, *none),
        ("scored", None, None, None, None, 0.2, -3.0, 0.7, 2, None, 1.5, 4, 0.91, False), ("scored", None, None, None, None, 0.2, -3.0, 0.7, 20, "p.jpg", -1.0, 3, 0.8, True),
    ]
    got = [r[0] for r in spark.createDataFrame(data, schema).select(explain.reason(0.27, 0.6)).collect()]
    assert got[0] == "File could not be decoded as an image." and got[1].endswith("The original copy is itself flagged.")
    assert "under o/f;" in got[2] and "similarity 0.10 < absolute floor 0.27" in got[3]
    assert got[4].startswith("Median similarity to peers 0.20 vs folder median 0.70 (modified z = -3.0; absolute floor 0.27).")
    assert "No geometric match to nearest peers (max 2 SIFT inliers)." in got[4] and "foreign as a whole" in got[4]
    assert "Partial geometric match to p.jpg (20 inliers)" in got[5] and "support level 0.60" in got[5]


def test_records_in_pieces_and_files(spark, tmp_path):
    data = [("g", f"i{i}", i + 1, 0.5 if i == 0 else None, i == 0, "why & <b>" if i == 0 else None, "scored", None, None) for i in range(5)]
    df = spark.createDataFrame(data, "grp string, item string, rank int, suspicion double, flagged boolean, reason string, kind string, s double, z double")
    folders = spark.createDataFrame([("g", None, False)], "grp string, median_s double, review boolean")
    rows = sorted(records.group_records(df, folders, piece=2).collect(), key=lambda r: r.piece)
    assert [r.ranking for r in rows] == [["i0", "i1"], ["i2", "i3"], ["i4"]] and all(r.total_images == 5 for r in rows)
    assert rows[0].flagged_images[0].suspicion_score == 0.5 and rows[1].flagged_images == []
    csv = records.csv_records(records.group_records(df, folders)).first()
    assert csv.folder_median_consensus == "" and csv.review_folder == 0 and csv.n_flagged == 1
    assert records.item_rows(df).where("rank = 2").first().suspicion_score == "nan"
    records.write_json_document(records.group_records(df, folders), f"{tmp_path}/r.json")
    import json

    assert json.load(open(f"{tmp_path}/r.json"))[0]["folder_median_consensus"] is None
    summary = {r.kind: r.n_flagged for r in records.flag_summary(df).collect()}
    assert summary == {"scored": 1, "all": 1}


def leaning(g):
    """Centres that lean to one axis by different amounts, so that groups aren't equally foreign to each other."""
    return between(axis(g), axis(63), 1 / np.sqrt(1 + (0.1 * (g + 1)) ** 2))


def test_geometry_clears_and_convicts(spark):
    """Items that are unlike their group: one shares its features with peers, the other has its own."""
    from peerlens.operators import geometry

    rng = np.random.default_rng(21)
    items, vectors, features = [], [], []
    for g in range(6):
        home = fan(leaning(g), 6, 0.95 + 0.005 * g, 6 + 8 * g)
        points, shared = rng.uniform(0, 300, (25, 2)), rng.normal(size=(25, 8))
        for k in range(8):
            v = home[k] if k < 6 else between(axis(6 + 8 * g + k), leaning(g), 0.99 - 0.01 * g)
            items.append((f"g{g}", f"i{k}", f"{g}-{k}", True, None))
            vectors.append((f"{g}-{k}", [float(x) for x in v]))
            d = rng.normal(size=(25, 8)) if k == 7 else shared + 0.01 * rng.normal(size=(25, 8))
            features.append((f"{g}-{k}", [{"x": float(x), "y": float(y)} for x, y in points + k], [[float(x) for x in r] for r in d]))
    frames = spark.createDataFrame(items, ITEMS), spark.createDataFrame(vectors, "sha string, vec array<double>"), spark.createDataFrame(features, geometry.FEATURES)
    got, _, ratio = decide.audit(frames[0], frames[1], CFG, features=frames[2])
    rows = {(r.grp, r["item"]): r for r in got.collect()}
    same, other = [rows[f"g{g}", "i6"] for g in range(6)], [rows[f"g{g}", "i7"] for g in range(6)]
    assert all(r.candidate for r in same + other)
    assert all(r.geom_inliers >= 20 and r.geom_log_lr < 0 for r in same) and all(r.geom_inliers < 10 and r.geom_log_lr > 0 for r in other)
    assert np.mean([r.suspicion for r in other]) > np.mean([r.suspicion for r in same])
    text = got.withColumn("reason", explain.reason(ratio.floor(0.3), ratio.support_floor)).where("item = 'i7'").first().reason
    assert "No geometric match to nearest peers" in text
