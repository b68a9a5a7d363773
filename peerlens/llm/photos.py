"""The photo records that problems 2, 4 and 5 share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Unicode and the ASCII controls see it, trimmed from hashes and verdicts.
BLANK = r"[\s\u0085   -​    　﻿\u001c-\u001f]"


def trimmed(col: Column) -> Column:
    """Lower case without surrounding white space."""
    return F.lower(F.regexp_replace(col, f"^{BLANK}+|{BLANK}+$", ""))


def hash_key(col: Column) -> Column:
    """A compact key of the trimmed lower-case text; null stays null.

    16 bytes of MD5 over the whole text instead of 64 characters, which is a
    quarter of what would be shuffled.
    """
    return F.unhex(F.md5(trimmed(col)))


def photo_records(images: DataFrame) -> DataFrame:
    """One row (image_id, batch_no, sha, bits) per record, from its lowest batch.

    ``bits`` is the dhash where it can be near another (32 bytes, some bit set),
    else null.  A record without image_id is none; a null batch counts as the
    last.  Of several rows in the lowest batch the greatest (sha, dhash) counts,
    null lowest, so a value wins over a missing one.
    """
    rows = images.where(F.col("image_id").isNotNull()).select(
        F.col("image_id").cast("long").alias("image_id"),
        F.coalesce(F.col("batch_no").cast("int"), F.lit(2147483647)).alias("batch_no"),
        hash_key(F.col("sha256")).alias("sha"),
        F.when((F.length("dhash") == 32) & (F.hex("dhash") != "0" * 64), F.col("dhash")).alias("bits"),
    )
    best = F.max(F.struct((-F.col("batch_no").cast("long")).alias("b"), "sha", "bits"))
    found = rows.groupBy("image_id").agg(best.alias("r"))
    return found.select("image_id", (-F.col("r.b")).cast("int").alias("batch_no"), F.col("r.sha").alias("sha"), F.col("r.bits").alias("bits"))
