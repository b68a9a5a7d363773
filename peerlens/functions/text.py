"""Token operators over recognised text: arrays of struct<text, conf>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space and punctuation that separate tokens.
SEPARATORS = r"[\s\p{Punct}।॥]+"


def tokens(items: Column, min_conf: float = 0.3) -> Column:
    """The set of lower-case tokens of two characters or more in items of enough confidence, sorted."""
    sure = F.filter(items, lambda x: x["conf"] >= min_conf)
    parts = F.flatten(F.transform(sure, lambda x: F.split(F.lower(x["text"]), SEPARATORS)))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda t: F.length(t) >= 2)))


def snippet(items: Column, n: int = 3, width: int = 60) -> Column:
    """The ``n`` texts of greatest confidence, earlier ones first among equals, joined and cut to ``width`` characters."""
    placed = F.transform(items, lambda x, i: F.struct((-x["conf"]).alias("c"), i.alias("i"), x["text"].alias("t")))
    joined = F.array_join(F.transform(F.slice(F.array_sort(placed), 1, n), lambda x: x["t"]), " | ")
    return F.when(F.length(joined) > width, F.concat(F.substring(joined, 1, width - 1), F.lit("…"))).otherwise(joined)


def overlap(a: Column, b: Column) -> Column:
    """How many tokens two sets share."""
    return F.size(F.array_intersect(a, b))


def extension(path: Column) -> Column:
    """The lower-case file extension; empty where there is none."""
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


#: File name extensions of images.
IMAGE_EXTENSIONS = ("bmp", "jpeg", "jpg", "png", "webp")


def is_image(path: Column) -> Column:
    return extension(path).isin(*IMAGE_EXTENSIONS)
