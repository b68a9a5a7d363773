"""Full rankings of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peerlens.operators.scratch import Scratch


def ranked(df: DataFrame, group: str, order: Sequence[Column], name: str = "rank", scratch: Scratch | None = None) -> DataFrame:
    """``df`` with the rank from 1 of each row in its group.

    The rows are sorted by ranges of (group, order), which cut large groups
    too; a row's rank is its place in its range plus the group's rows in the
    ranges before, a table of one row per group and range.  ``order`` must tell
    rows apart, or ranks of equal rows are arbitrary.
    """
    scratch = scratch or Scratch(df.sparkSession, "ranking")
    keys = [F.col(group).asc_nulls_first(), *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = scratch.save(placed.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "placed")
    runs = placed.groupBy("__part", group).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.partitionBy(group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select(F.col("__part").alias("__p"), F.col(group).alias("__g"), "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    same = (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g"))
    return placed.join(runs, same).withColumn(name, (F.col("__at") - F.col("__first") + F.col("__before") + 1).cast("int")).drop("__part", "__at", "__p", "__g", "__first", "__before")


def quantiles(df: DataFrame, group: str, value: str, at: Sequence[float], scratch: Scratch | None = None) -> DataFrame:
    """(group, n, q): the interpolated quantiles of each group's values, exact; null values don't count.

    Values get their ranks by ``ranked``, and only the rows at the wanted ranks
    meet in one place, so no task holds a group.
    """
    placed = ranked(df.where(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("__x")), group, [F.col("__x").asc()], "__rank", scratch)
    n = placed.groupBy(group).agg(F.max("__rank").alias("n"))
    ends = [(F.floor((F.col("n") - 1) * p), F.ceil((F.col("n") - 1) * p)) for p in at]
    here = placed.join(n, group).withColumn("__r", F.col("__rank") - 1)
    wanted = here.where(reduce(or_, [(F.col("__r") == lo) | (F.col("__r") == hi) for lo, hi in ends]))
    picked = wanted.groupBy(group, "n").agg(*[F.max(F.when(F.col("__r") == e, F.col("__x"))).alias(f"__{i}_{j}") for i, pair in enumerate(ends) for j, e in enumerate(pair)])
    parts = [F.col(f"__{i}_0") + (F.col(f"__{i}_1") - F.col(f"__{i}_0")) * ((F.col("n") - 1) * p - F.floor((F.col("n") - 1) * p)) for i, p in enumerate(at)]
    return picked.select(group, "n", F.array(*parts).alias("q"))


def suspicion_order() -> list[Column]:
    """Suspicion descending (missing last), z ascending (missing as 0), item."""
    return [F.col("suspicion").desc_nulls_last(), F.coalesce("z", F.lit(0.0)).asc(), F.col("item").asc()]


def running_totals(df: DataFrame, groups: Sequence[str], order: Sequence[Column], totals: dict[str, Column], scratch: Scratch | None = None) -> DataFrame:
    """``df`` with running sums, up to and including each row, of ``totals`` in the order within its group.

    Ranges of (groups, order) are summed apart, and each range starts from the
    sums of the group's ranges before it.
    """
    scratch = scratch or Scratch(df.sparkSession, "totals")
    keys = [*[F.col(g).asc_nulls_first() for g in groups], *order]
    placed = df.withColumns({f"__v_{n}": c for n, c in totals.items()}).repartitionByRange(*keys).withColumn("__part", F.spark_partition_id())
    placed = scratch.save(placed, "placed")
    sums = placed.groupBy("__part", *groups).agg(*[F.sum(f"__v_{n}").alias(f"__s_{n}") for n in totals])
    before = W.partitionBy(*groups).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("__part", *groups, *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in totals])
    inside = W.partitionBy("__part", *groups).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = placed.join(starts, ["__part", *groups])
    out = out.withColumns({n: F.sum(f"__v_{n}").over(inside) + F.col(f"__b_{n}") for n in totals})
    return out.drop("__part", *[f"__{k}_{n}" for k in "vb" for n in totals])
