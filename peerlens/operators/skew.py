"""Joins of many rows to one row a key, where one key may hold a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.operators.scratch import Scratch

#: Rows under one key that still go to one task, and the most keys that are ever broadcast.
HOT_ROWS, MOST_KEYS = 1_000_000, 10_000


def join_to_one(rows: DataFrame, ones: DataFrame, on: Sequence[str], scratch: Scratch, how: str = "inner", hot: int = HOT_ROWS) -> DataFrame:
    """``rows`` (a stored table) joined with ``ones``, which has each key once.

    A key with more than ``hot`` rows, or more than a ``MOST_KEYS``-th of all,
    is hot; there are no more than ``MOST_KEYS`` of them, and the rows of
    ``ones`` under them are broadcast, so hot rows stay where they are.  All
    others meet by Spark's own choice of join.
    """
    n = rows.count()
    if n <= hot:
        return rows.join(ones, list(on), how)
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max(hot, n // MOST_KEYS))
    keys = scratch.save(counted.select(*on), "hot-keys")
    if keys.isEmpty():
        return rows.join(ones, list(on), how)
    few = ones.join(F.broadcast(keys), list(on), "left_semi")
    return rows.join(F.broadcast(keys), list(on), "left_semi").join(F.broadcast(few), list(on), how).unionByName(
        rows.join(F.broadcast(keys), list(on), "left_anti").join(ones, list(on), how)
    )
