"""Aggregates that Spark has but does not name in its public functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

try:
    from pyspark.sql.internal import InternalFunction

    _TOP = InternalFunction.collect_top_k
except (ImportError, AttributeError):  # pragma: no cover
    _TOP = None


def smallest(col: Column, k: int) -> Column:
    """The ``k`` smallest values of a group in order: a bounded heap that is merged after the shuffle.

    On a Spark without that aggregate the values of a group are gathered first.
    """
    if _TOP is None:  # pragma: no cover
        return F.slice(F.array_sort(F.collect_list(col)), 1, k)
    return F.array_sort(_TOP(col, k, True))
