"""Density-ratio calibration without labels.

How alike items of one group are (``pos``) and how alike items are to a foreign
group (``neg``) are two samples of numbers; their Gaussian kernel densities and
a prior give the posterior that an item is foreign.

A sample of any size is reduced to counts and means over narrow bins before it
leaves the executors, so the fit collects a bounded table.  The densities and
their slopes are computed once on nodes over the sample range; an item's value
is a cubic interpolation between two nodes, so scoring costs the same whatever
the sample size.  Against the densities over all sample points the difference
is below 1e-6 for bandwidths of a hundredth of the range and more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of a sample, nodes of the density, and points of the search for a floor.
BINS, NODES, GRID = 16384, 4096, 2001
#: Log ratios are cut to this on either side.
CUT = 12.0


@dataclass(frozen=True)
class Ratio:
    """Log ratio of the foreign to the own density on [lo, hi], and the prior."""

    prior: float
    lo: float
    hi: float
    nodes: np.ndarray
    values: np.ndarray
    slopes: np.ndarray
    n_pos: int = 0
    n_neg: int = 0
    bw_pos: float = 0.0
    bw_neg: float = 0.0

    def log_lr(self, x: np.ndarray) -> np.ndarray:
        """Of each value, cut to the sample range before and to ±CUT after; NaN stays."""
        x = np.clip(np.asarray(x, np.float64), self.lo, self.hi)
        if len(self.nodes) == 1:
            return np.where(np.isnan(x), np.nan, np.clip(self.values[0], -CUT, CUT))
        h = self.nodes[1] - self.nodes[0]
        i = np.clip(np.nan_to_num((x - self.nodes[0]) / h), 0, len(self.nodes) - 2).astype(np.int64)
        t = (x - self.nodes[i]) / h
        a, b, da, db = self.values[i], self.values[i + 1], self.slopes[i] * h, self.slopes[i + 1] * h
        y = a + t * (da + t * (3 * (b - a) - 2 * da - db + t * (2 * (a - b) + da + db)))
        return np.clip(y, -CUT, CUT)

    def posterior(self, x: np.ndarray, extra: np.ndarray | float = 0.0) -> np.ndarray:
        return 1 / (1 + np.exp(-(np.log(self.prior / (1 - self.prior)) + self.log_lr(x) + extra)))

    def floor(self, p: float, grid: int = GRID) -> float:
        """The greatest of ``grid`` even points whose posterior is ``p`` or more; the least value if none is."""
        at = np.linspace(self.lo, self.hi, grid)
        ok = at[self.posterior(at) >= p]
        return float(ok.max()) if len(ok) else self.lo

    @property
    def support_floor(self) -> float:
        """The similarity from which on the evidence speaks for the group: the posterior is the prior."""
        return self.floor(self.prior)


def binned(samples: DataFrame, side: str = "side", x: str = "x", bins: int = BINS) -> tuple[dict, pd.DataFrame]:
    """Exact (n, mean, deviation, least, greatest) of each side, and (side, n, mean) of its bins; no more rows than bins."""
    use = samples.where(F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))).select(F.col(side).alias("side"), F.col(x).cast("double").alias("x"))
    totals = {r["side"]: r for r in use.groupBy("side").agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
    if not totals:
        return totals, pd.DataFrame({"side": [], "n": [], "mean": []})
    lo, hi = min(r["lo"] for r in totals.values()), max(r["hi"] for r in totals.values())
    width = (hi - lo) / bins or 1.0
    at = F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))
    return totals, use.groupBy("side", at.alias("bin")).agg(F.count("x").alias("n"), F.avg("x").alias("mean")).orderBy("side", "bin").toPandas()


def _log_density(at: np.ndarray, n: np.ndarray, mean: np.ndarray, bw: float) -> tuple[np.ndarray, np.ndarray]:
    """ln(density + 1e-300) and its slope at the points."""
    value, slope = np.zeros(len(at)), np.zeros(len(at))
    total = n.sum() * bw * np.sqrt(2 * np.pi)
    for begin in range(0, len(mean), 1024):
        u = (at[:, None] - mean[None, begin : begin + 1024]) / bw
        k = np.exp(-0.5 * u * u) * n[None, begin : begin + 1024]
        value += k.sum(1)
        slope -= (k * u).sum(1) / bw
    value, slope = value / total + 1e-300, slope / total
    return np.log(value), slope / value


def fit(samples: DataFrame, prior: float, side: str = "side", x: str = "x") -> Ratio:
    """The ratio from samples with sides ``pos`` and ``neg``; Scott's bandwidth; null and non-finite values are left out.

    ValueError where a side has fewer than two values or no spread, as then it
    has no density.
    """
    totals, table = binned(samples, side, x)
    for s in ("pos", "neg"):
        if s not in totals or totals[s]["n"] < 2 or not totals[s]["sd"]:
            raise ValueError(f"the {s} sample needs two different values at least")
    lo, hi = min(r["lo"] for r in totals.values()), max(r["hi"] for r in totals.values())
    nodes = np.linspace(lo, hi, NODES + 1)
    bw = {s: totals[s]["sd"] * totals[s]["n"] ** -0.2 for s in ("pos", "neg")}
    found = {}
    for s in ("pos", "neg"):
        part = table[table["side"] == s]
        found[s] = _log_density(nodes, part["n"].to_numpy(np.float64), part["mean"].to_numpy(), bw[s])
    return Ratio(
        prior, lo, hi, nodes, found["neg"][0] - found["pos"][0], found["neg"][1] - found["pos"][1],
        totals["pos"]["n"], totals["neg"]["n"], bw["pos"], bw["neg"],
    )


def with_posterior(df: DataFrame, ratio: Ratio, x: str, name: str, extra: str | None = None) -> DataFrame:
    """``df`` with the posterior of column ``x`` and the evidence in ``extra``; null where ``x`` is null."""
    return _scored(df, ratio, x, name, extra, True)


def with_log_lr(df: DataFrame, ratio: Ratio, x: str, name: str) -> DataFrame:
    """``df`` with the log ratio of column ``x``; null where ``x`` is null."""
    return _scored(df, ratio, x, name, None, False)


def _scored(df: DataFrame, ratio: Ratio, x: str, name: str, extra: str | None, posterior: bool) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(ratio)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        r = shared.value
        for value, more in parts:
            v = value.to_numpy(np.float64)
            y = r.posterior(v, more.to_numpy(np.float64)) if posterior else r.log_lr(v)
            yield pd.Series(y).where(value.notna().to_numpy(), None)

    more: Column = F.coalesce(F.col(extra), F.lit(0.0)) if extra else F.lit(0.0)
    y = score(F.col(x).cast("double"), more)
    return df.withColumn(name, F.when(F.col(x).isNotNull(), y))


def hashed_order(seed: int, salt: str, *columns: str) -> Column:
    """A draw that depends on nothing but the seed and the values: SHA-256 of both."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), *[F.col(c).cast("string") for c in columns]), 256)


def donors(groups: DataFrame, seed: int, salt: str = "donor") -> DataFrame:
    """(grp, donor): another group for each group, drawn by hash order.

    Groups stand on a ring in the order of their hash, and each takes the next:
    one draw without looking at all pairs of groups.  ``groups`` (grp) has each
    group once; ValueError with fewer than two.
    """
    ring = groups.select("grp", hashed_order(seed, salt, "grp").alias("at"))
    # Each group's successor within a bucket of the hash; a bucket's last takes the first of the next bucket that has any.
    from pyspark.sql import Window as W

    bucketed = ring.withColumn("bucket", F.substring("at", 1, 3))
    w = W.partitionBy("bucket").orderBy("at", "grp")
    inside = bucketed.select("grp", "bucket", F.lead("grp").over(w).alias("donor"))
    firsts = bucketed.groupBy("bucket").agg(F.min(F.struct("at", "grp")).alias("f")).select("bucket", F.col("f.grp").alias("first"))
    # At most 4,096 buckets, so this ring of buckets is one small partition.
    one = W.partitionBy(F.lit(1)).orderBy("bucket")
    nexts = firsts.select("bucket", F.coalesce(F.lead("first").over(one), F.first("first").over(one)).alias("next"))
    found = inside.join(nexts, "bucket").select("grp", F.coalesce("donor", "next").alias("donor"))
    if found.limit(2).count() < 2:
        raise ValueError("a foreign sample needs two groups at least")
    return found
