"""A profile of a dataset before anything is computed from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_sizes(items: DataFrame) -> DataFrame:
    """(n_groups, n_items, min_size, median_size, max_size, n_small) over groups; small ones have two items at most."""
    sizes = items.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_items"), F.min("n").alias("min_size"),
        F.median("n").alias("median_size"), F.max("n").alias("max_size"), F.count_if(F.col("n") <= 2).alias("n_small"),
    )


def size_histogram(items: DataFrame, width: int = 5) -> DataFrame:
    """(size_from, n_groups) of group sizes in steps of ``width``."""
    sizes = items.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy((F.floor(F.col("n") / width) * width).alias("size_from")).agg(F.count(F.lit(1)).alias("n_groups"))


def top_values(items: DataFrame, column: str, n: int = 5) -> DataFrame:
    """(value, times) of the ``n`` commonest values, by value among equals."""
    counted = items.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("times"))
    return counted.orderBy(F.col("times").desc(), F.col("value").asc_nulls_first()).limit(n)


def copy_counts(items: DataFrame, copies: DataFrame) -> DataFrame:
    """(exact, near, cross, unreadable): extra copies of a content inside groups, extra contents inside sets of copies, contents under several groups, unreadable items."""
    sets = copies.where("size > 1").select("grp", "item", "root").join(items.select("grp", "item", "sha"), ["grp", "item"])
    per_set = sets.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce("sha", "item")).alias("d"))
    zero = F.lit(0).cast("bigint")
    parts = [
        per_set.select((F.col("n") - F.col("d")).alias("exact"), (F.col("d") - 1).alias("near"), zero.alias("cross"), zero.alias("unreadable")),
        items.where("sha is not null").groupBy("sha").agg(F.count_distinct("grp").alias("g")).where("g > 1").select(zero.alias("exact"), zero.alias("near"), F.lit(1).cast("bigint").alias("cross"), zero.alias("unreadable")),
        items.where(~F.coalesce("readable", F.lit(False))).select(zero.alias("exact"), zero.alias("near"), zero.alias("cross"), F.lit(1).cast("bigint").alias("unreadable")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("exact", "near", "cross", "unreadable")])


def file_counts(files: DataFrame) -> DataFrame:
    """(n_resolutions, min_kb, median_kb, max_kb, with_exif, with_date, with_gps) of the files of ``sources.images.images``; a kilobyte is 1,024 bytes, cut down."""
    kb = F.floor(F.col("size") / 1024)
    readable = F.coalesce("readable", F.lit(False))
    return files.agg(
        F.count_distinct(F.when(readable, F.struct("width", "height"))).alias("n_resolutions"), F.min(kb).alias("min_kb"), F.median(kb).alias("median_kb"), F.max(kb).alias("max_kb"),
        *[F.count_if(readable & F.col(c)).alias(f"with_{c[4:]}") for c in ("has_exif", "has_date", "has_gps")],
    )
