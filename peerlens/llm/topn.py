"""Top N items within every group.

A mergeable aggregate keeps one heap of at most N entries per group.  It is
built in each map task before the shuffle, so a group of any size sends at most
N entries per task, and merged after it.  Entries compare by the ordering keys
in turn and last by the unique identifier, so the result does not depend on the
partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.functions.aggregates import smallest

_COMPLEMENT = ("0123456789ABCDEF", "FEDCBA9876543210")


def ascending_key(col: Column, kind: T.DataType, descending: bool) -> Column:
    """A value whose ascending order is the order asked for; null and NaN come last.

    Doubles are negated, integers complemented (no overflow at the least value),
    strings and binaries complemented digit by digit with an end mark, so a
    longer string comes before its prefix.
    """
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = col.cast("double")
        value = F.when(~F.isnan(value), (-value if descending else value) + F.lit(0.0))
        return F.struct(value.isNull().alias("last"), value.alias("key"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.TimestampType, T.DateType, T.BooleanType)):
        if isinstance(kind, T.TimestampType):
            col = F.unix_micros(col)
        elif isinstance(kind, T.DateType):
            col = F.unix_date(col)
        value = col.cast("long")
        value = F.bitwise_not(value) if descending else value
        return F.struct(value.isNull().alias("last"), value.alias("key"))
    if isinstance(kind, T.DecimalType):
        return F.struct(col.isNull().alias("last"), (-col if descending else col).alias("key"))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        value = F.concat(F.translate(F.hex(col), *_COMPLEMENT), F.lit("G")) if descending else col
        return F.struct(value.isNull().alias("last"), value.alias("key"))
    raise TypeError(f"no order for {kind.simpleString()}")


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[tuple[str, str]],
    item: str,
    n: int,
    *,
    keep: Sequence[str] = (),
    rank: str = "rank_no",
) -> DataFrame:
    """The first ``n`` rows of every group, with their rank from 1.

    ``order`` lists (column, "asc" or "desc"); ``item`` is the identifier that
    breaks ties, ascending.  Columns of the result: ``group``, ``rank``,
    ``item``, ``keep``.

    Null and NaN order values come last; rows whose identifier is null are left
    out; null group values form a group of their own.  Rows that are equal in
    every order column and in ``item`` are kept as separate entries, so callers
    that want each item once reduce to one row per item first.  An empty table
    gives an empty result.  Columns not named are ignored, whatever their names.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if len({*group, item, *keep, rank}) != len(group) + len(keep) + 2:
        raise ValueError("group, item, keep and rank must be different columns")
    kinds = {f.name: f.dataType for f in df.select(*group, item, *keep, *[c for c, _ in order]).schema}
    keys = [ascending_key(F.col(c), kinds[c], how == "desc").alias(f"k{i}") for i, (c, how) in enumerate(order)]
    entry = F.struct(*keys, ascending_key(F.col(item), kinds[item], False).alias("id"), F.col(item).alias("item"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(keep)])
    heaps = df.where(F.col(item).isNotNull()).groupBy(*group).agg(smallest(entry, n).alias("__heap"))
    # The final heap comes out unordered by contract; sorting at most n entries fixes the ranks.
    return heaps.select(*group, F.posexplode(F.array_sort("__heap")).alias("__pos", "__entry")).select(
        *group,
        (F.col("__pos") + 1).cast("int").alias(rank),
        F.col("__entry.item").alias(item),
        *[F.col(f"__entry.v{i}").alias(c) for i, c in enumerate(keep)],
    )


def latest_rows(df: DataFrame, key: Sequence[str], newest: str, tie: str, keep: Sequence[str]) -> DataFrame:
    """One row per ``key``: the one with the greatest (``newest``, ``tie``); null counts as oldest."""
    best = F.max(F.struct(F.col(newest).alias("a"), F.col(tie).alias("b"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(keep)]))
    return df.groupBy(*key).agg(best.alias("__best")).select(*key, *[F.col(f"__best.v{i}").alias(c) for i, c in enumerate(keep)])


def suspicious_photos(evals: DataFrame, results: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most suspicious photos of every outlet in three lists.

    ``evals``: the newest evaluation of each photo, by suspicion descending, z
    ascending (null or NaN as 0), file name.  ``flagged``: the greatest score
    of each file over all flagged lists, descending.  ``ranking``: the smallest
    position of each file over all stored rankings.  Rows without an outlet or
    file name are left out; a file counts once per list.

    Each list first becomes one row per (outlet, file) by an aggregation whose
    key contains the file, so an outlet of any size is spread over all tasks;
    then one heap aggregation serves all three.
    """
    newest = latest_rows(
        evals.where(F.col("outlet").isNotNull() & F.col("file_name").isNotNull()),
        ["outlet", "file_name"], "evaluated_at", "eval_id", ["suspicion", "z"],
    ).where(F.col("suspicion").isNotNull() & ~F.isnan("suspicion"))
    z = F.coalesce(F.nanvl("z", F.lit(0.0)), F.lit(0.0))
    by_eval = newest.select(
        F.col("outlet").alias("outlet_id"), F.lit("evals").alias("list_name"), (-F.col("suspicion")).alias("first"), z.alias("second"), "file_name",
    )
    stored = results.where(F.col("outlet_id").isNotNull())
    flagged = stored.select("outlet_id", F.explode("flagged_images").alias("e")).select(
        "outlet_id", F.col("e.file_name").alias("file_name"), F.col("e.suspicion_score").alias("score"),
    )
    flagged = flagged.where(F.col("file_name").isNotNull() & F.col("score").isNotNull() & ~F.isnan("score"))
    flagged = flagged.groupBy("outlet_id", "file_name").agg(F.max("score").alias("score"))
    by_flag = flagged.select("outlet_id", F.lit("flagged").alias("list_name"), (-F.col("score")).alias("first"), F.lit(0.0).alias("second"), "file_name")
    placed = stored.select("outlet_id", F.posexplode("ranking").alias("pos", "file_name")).where(F.col("file_name").isNotNull())
    placed = placed.groupBy("outlet_id", "file_name").agg(F.min("pos").alias("pos"))
    by_place = placed.select("outlet_id", F.lit("ranking").alias("list_name"), F.col("pos").cast("double").alias("first"), F.lit(0.0).alias("second"), "file_name")
    lists = by_eval.unionByName(by_flag).unionByName(by_place)
    return top_n_per_group(lists, ["outlet_id", "list_name"], [("first", "asc"), ("second", "asc")], "file_name", n)
