import pytest

from peerlens.operators import harness as h

ROWS = "k string, score double, label boolean, candidate boolean"


def table(spark, data, thresholds):
    return {r.threshold: r for r in h.pr_table(spark.createDataFrame(data, ROWS), ["k"], thresholds).collect()}


def test_thresholds():
    assert len(h.THRESHOLDS) == 25 and h.THRESHOLDS[0] == 0.02 and h.THRESHOLDS[-1] == 0.95


def test_pr_and_ap(spark):
    data = [("k", s, bool(y), True) for s, y in zip([0.9, 0.8, 0.4, 0.3, 0.1], [1, 0, 1, 0, 0])]
    got = table(spark, data, [0.5, 0.35, 0.0])
    assert (got[0.5].precision, got[0.5].recall, got[0.5].n_flagged) == (0.5, 0.5, 2)
    assert got[0.35].precision == pytest.approx(2 / 3) and got[0.35].recall == 1 and got[0.0].precision == pytest.approx(0.4)
    assert h.average_precision(spark.createDataFrame(data, ROWS), ["k"]).first().ap == pytest.approx((1 + 2 / 3) / 2)


def test_gated(spark):
    got = table(spark, [("k", 0.9, True, True), ("k", 0.9, True, False)], [0.5])
    assert got[0.5].n_flagged == 1 and got[0.5].recall == 0.5


def test_empty_denominators_ties_and_nulls(spark):
    got = table(spark, [("k", 0.1, False, True), ("k", None, False, True)], [0.5])
    assert (got[0.5].precision, got[0.5].recall, got[0.5].f_beta) == (0, 0, 0)
    tied = spark.createDataFrame([("k", 0.5, True, True), ("k", 0.5, False, True), ("k", None, True, True)], ROWS)
    assert h.average_precision(tied, ["k"]).first().ap == pytest.approx(0.5)
    none = spark.createDataFrame([("k", 0.5, False, True)], ROWS)
    assert h.average_precision(none, ["k"]).first().ap == 0


def test_best_threshold_prefers_the_lowest(spark):
    data = [("k", 0.9, True, True), ("k", 0.1, False, True)]
    best = h.best_threshold(h.pr_table(spark.createDataFrame(data, ROWS), ["k"]), ["k"]).first()
    assert best.threshold == pytest.approx(0.12) and best.f_beta == 1


def test_planted_items(spark):
    items = spark.createDataFrame([("a", "x", "s1", True, None), ("b", "y", "s1", True, None), ("b", "z", "s2", True, None)], "grp string, item string, sha string, readable boolean, bits binary")
    pairs = spark.createDataFrame([("a", "b")], "grp string, donor string")
    got = h.planted(items, items, pairs, 5, 0).collect()
    assert [(r.grp, r["item"], r.sha) for r in got] == [("a", "__inj__b__z", "s2")]


def test_operating_point(spark):
    best = spark.createDataFrame([(2.5, "easy", 0.3, 0.5, 0.6, 0.4), (3.0, "easy", 0.4, 0.5, 0.6, 0.3), (3.5, "hard", 0.1, 0.9, 0.9, 0.9)], "z double, pool string, threshold double, f_beta double, precision double, recall double")
    got = h.operating_point(best, "easy").first()
    assert got.z == 2.5 and got.threshold == 0.3


def test_without_keys_and_targets(spark):
    rows = spark.createDataFrame([("k", 0.9, True, True), ("j", 0.1, False, True)], ROWS)
    got = {r.threshold: r for r in h.pr_table(rows, [], [0.5]).collect()}
    assert got[0.5].precision == 1 and "__all" not in got[0.5].asDict()
    groups = spark.createDataFrame([(f"g{i}",) for i in range(9)], "grp string")
    a, b = ({r.grp for r in h.targets(groups, 0.5, s).collect()} for s in (0, 1))
    assert len(a) == len(b) == 4 and a != b and a == {r.grp for r in h.targets(groups.repartition(3), 0.5, 0).collect()}
    assert h.targets(groups, 0.0, 0).count() == 1
