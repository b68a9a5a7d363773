"""Images on a file system as rows: one directory per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.functions.exif import exif
from peerlens.functions.hashing import content_key, dhash, gray, phash
from peerlens.functions.text import is_image


def _parts(path):
    parts = F.split(path, "/")
    return F.element_at(parts, -2), F.element_at(parts, -1)


def scan(spark: SparkSession, root: str) -> DataFrame:
    """(grp, item, path, sha, size, orientation, has_exif, has_date, has_gps) of the image files one level below ``root``; unreadable files are kept.

    Extensions are compared without case.  The file bytes stay in the scan:
    only their hash and what their EXIF block says leave it.
    """
    files = spark.read.format("binaryFile").load(root.rstrip("/") + "/*/*")
    grp, item = _parts(F.col("path"))

    @F.pandas_udf("orientation int, has_exif boolean, has_date boolean, has_gps boolean")
    def said(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for heads in parts:
            yield pd.DataFrame([exif(h) for h in heads], columns=["orientation", "has_exif", "has_date", "has_gps"])

    # The format has the block before the pixels, in at most 64 KB.
    rows = files.where(is_image(F.col("path"))).withColumn("e", said(F.substring("content", 1, 1 << 18)))
    return rows.select(grp.alias("grp"), item.alias("item"), "path", F.sha2("content", 256).alias("sha"), F.col("length").alias("size"), "e.*")


def decoded(spark: SparkSession, root: str) -> DataFrame:
    """(grp, item, readable, turns, width, height): what decoding tells, with the perceptual hash of readable images for each orientation from 1 to 8.

    Decoding is Spark's image source, which gives pixels as they are stored.  A
    hash of each way to turn the image is small, so the pixels needn't meet the
    orientation.  A file that cannot be decoded has ``readable`` false and null
    ``turns``.
    """
    images = spark.read.format("image").option("dropInvalid", False).load(root.rstrip("/") + "/*/*")
    grp, item = _parts(F.col("image.origin"))

    @F.pandas_udf("array<binary>")
    def hashes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for p in parts:
            yield pd.Series([_turns(r) for r in p.itertuples(index=False)])

    readable = F.coalesce(F.col("image.height") > 0, F.lit(False))
    turns = F.when(readable, hashes(F.struct("image.height", "image.width", "image.nChannels", "image.data")))
    return images.where(is_image(F.col("image.origin"))).select(grp.alias("grp"), item.alias("item"), readable.alias("readable"), turns.alias("turns"), F.col("image.width").alias("width"), F.col("image.height").alias("height"))


def _pixels(r) -> np.ndarray:
    return gray(np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels))


def _turns(r) -> list[bytes] | None:
    return None if r.data is None or r.height <= 0 else [dhash(_pixels(r), orientation=o) for o in range(1, 9)]


def images(spark: SparkSession, root: str) -> DataFrame:
    """(grp, item, path, sha, size, orientation, has_exif, has_date, has_gps, readable, bits, width, height) of a directory of groups.

    ``bits`` is of the image as it is to be seen; width and height are as stored.
    """
    both = scan(spark, root).join(decoded(spark, root), ["grp", "item"], "left").withColumn("readable", F.coalesce("readable", F.lit(False)))
    return both.withColumn("bits", F.element_at("turns", F.col("orientation"))).drop("turns")


def items_of(table: DataFrame, grp: str = "outlet", item: str = "file_name", sha: str = "sha256", readable: str = "readable", bits: str = "dhash") -> DataFrame:
    """(grp, item, sha, readable, bits) from a stored table; hashes lose their case and blanks, bits that can't be compared are null."""
    usable = F.when((F.length(bits) == 32) & (F.hex(bits) != "0" * 64), F.col(bits))
    return table.select(
        F.col(grp).alias("grp"), F.col(item).alias("item"), content_key(F.col(sha)).alias("sha"), F.coalesce(readable, F.lit(False)).alias("readable"), usable.alias("bits"),
    )


class PhashEmbedder:
    """Vectors from low frequencies of the gray image; their cosine is one less twice the share of differing bits."""

    tag, dim = "phash", 64

    def embed(self, spark: SparkSession, root: str) -> DataFrame:
        """(sha, vec) of the distinct readable contents below ``root``."""
        images = spark.read.format("image").option("dropInvalid", True).load(root.rstrip("/") + "/*/*")
        grp, item = _parts(F.col("image.origin"))

        @F.pandas_udf("array<array<double>>")
        def vectors(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for p in parts:
                yield pd.Series([[phash(_pixels(r), o).tolist() for o in range(1, 9)] for r in p.itertuples(index=False)])

        rows = images.where("image.height > 0").select(grp.alias("grp"), item.alias("item"), vectors(F.struct("image.height", "image.width", "image.nChannels", "image.data")).alias("turns"))
        found = rows.join(scan(spark, root).select("grp", "item", "sha", "orientation"), ["grp", "item"])
        return found.groupBy("sha").agg(F.min(F.element_at("turns", F.col("orientation"))).alias("vec"))


class TableEmbedder:
    """Vectors that a model has computed elsewhere, from a table with sha and vec."""

    def __init__(self, tag: str, dim: int, table: DataFrame):
        self.tag, self.dim, self.table = tag, dim, table

    def embed(self, spark: SparkSession, root: str) -> DataFrame:
        return self.table.where(F.size("vec") == self.dim).select("sha", "vec")


def get_embedder(kind: str, tables: dict[str, DataFrame] | None = None):
    """The embedder of a name: ``phash`` is computed here, ``dinov2`` and ``clip`` are read from tables; ValueError for others."""
    if kind == "phash":
        return PhashEmbedder()
    dims = {"dinov2": 768, "clip": 512}
    if kind in dims and tables and kind in tables:
        return TableEmbedder(kind, dims[kind], tables[kind])
    raise ValueError(f"no embedder {kind!r}" + ("" if kind not in dims else ": give its table of vectors"))


def cached_vectors(spark: SparkSession, root: str, items: DataFrame, embedder, cache_dir: str) -> DataFrame:
    """(sha, vec) of the readable ``items`` (sha, readable) below ``root``: computed once for each content and kept below ``cache_dir``."""
    from peerlens.sources.cache import ContentCache

    cache = ContentCache(spark, f"{cache_dir.rstrip('/')}/vectors", embedder.tag, "sha string, vec array<double>")
    wanted = items.where("readable").select("sha")
    if not cache.misses(wanted).isEmpty():
        cache.fill(wanted, lambda misses: embedder.embed(spark, root).join(misses.select("sha"), "sha", "left_semi"))
    return cache.read()
