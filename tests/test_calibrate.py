import numpy as np
import pytest
from pyspark.sql import functions as F

from peerlens.operators import calibrate


def exact_log_lr(x, pos, neg):
    def kde(s):
        bw = np.std(s, ddof=1) * len(s) ** -0.2
        return np.exp(-0.5 * ((x[:, None] - s) / bw) ** 2).mean(1) / (bw * np.sqrt(2 * np.pi))

    x = np.clip(x, min(pos.min(), neg.min()), max(pos.max(), neg.max()))
    return np.clip(np.log(kde(neg) + 1e-300) - np.log(kde(pos) + 1e-300), -12, 12)


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(1)
    pos, neg = rng.normal(0.7, 0.05, 2000), rng.normal(0.2, 0.08, 2000)
    data = [("pos", float(v)) for v in pos] + [("neg", float(v)) for v in neg] + [("pos", None), ("neg", float("nan")), ("pos", float("inf"))]
    df = spark.createDataFrame(data, "side string, x double")
    return df, calibrate.fit(df, 0.05), pos, neg


def test_equals_direct_densities(fitted):
    _, ratio, pos, neg = fitted
    x = np.linspace(-0.3, 1.2, 401)
    assert np.abs(ratio.log_lr(x) - exact_log_lr(x, pos, neg)).max() < 1e-4


def test_behaviour(fitted):
    df, ratio, *_ = fitted
    assert ratio.posterior(np.array([0.2]))[0] > 0.9 and ratio.posterior(np.array([0.7]))[0] < 0.1
    assert (np.diff(ratio.log_lr(np.linspace(0.2, 0.7, 50))) <= 1e-9).all()
    assert 0.2 < ratio.floor(0.5) < 0.7
    assert calibrate.fit(df, 0.5).posterior(np.array([0.45]))[0] > ratio.posterior(np.array([0.45]))[0]
    assert ratio.posterior(np.array([0.5]), 3.0)[0] > ratio.posterior(np.array([0.5]))[0] > ratio.posterior(np.array([0.5]), -3.0)[0]
    assert ratio.floor(1.1) == ratio.lo


def test_columns(spark, fitted):
    _, ratio, *_ = fitted
    df = spark.createDataFrame([(0.2, None), (None, 1.0), (0.2, 2.0)], "s double, e double")
    got = calibrate.with_log_lr(calibrate.with_posterior(df, ratio, "s", "p", "e"), ratio, "s", "l").collect()
    assert got[1].p is None and got[1].l is None
    assert got[2].p > got[0].p > 0.9


@pytest.mark.parametrize("data", [[], [("pos", 1.0), ("pos", 2.0)], [("pos", 1.0), ("neg", 1.0), ("neg", 2.0)], [("pos", 1.0), ("pos", 1.0), ("neg", 1.0), ("neg", 2.0)]])
def test_no_density(spark, data):
    with pytest.raises(ValueError, match="sample needs"):
        calibrate.fit(spark.createDataFrame(data, "side string, x double"), 0.05)


def test_donors_are_others(spark):
    groups = spark.createDataFrame([(f"g{i}",) for i in range(100)], "grp string")
    got = {r.grp: r.donor for r in calibrate.donors(groups, 0).collect()}
    assert len(got) == 100 and set(got.values()) == set(got) and all(a != b for a, b in got.items())
    again = {r.grp: r.donor for r in calibrate.donors(groups.repartition(7), 0).collect()}
    assert got == again
    assert got != {r.grp: r.donor for r in calibrate.donors(groups, 1).collect()}
    with pytest.raises(ValueError, match="two groups"):
        calibrate.donors(groups.limit(1), 0)
