"""The pN_ queries: (spark, directory of the tables) -> result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from peerlens.llm import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = sql.ORACLE


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from peerlens.llm.topn import suspicious_photos

    return suspicious_photos(_table(spark, sf_dir, "image_evals"), _table(spark, sf_dir, "results"))


@_query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from peerlens.llm.components import photo_groups

    return photo_groups(_table(spark, sf_dir, "images"), _table(spark, sf_dir, "match_pairs"))


@_query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from peerlens.llm.increments import repeated_photos

    return repeated_photos(_table(spark, sf_dir, "images"))


@_query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from peerlens.llm.paritysketch import near_photos, photo_pairs

    return photo_pairs(near_photos(_table(spark, sf_dir, "images")))


@_query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from peerlens.llm.permutation import similar_photos

    return similar_photos(_table(spark, sf_dir, "image_vectors"))


@_query
def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from peerlens.llm.tokens import encoded

    return encoded(_table(spark, sf_dir, "documents"), "doc_id", "text")


@_query
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from peerlens.llm.leaks import leaked_items

    return leaked_items(_table(spark, sf_dir, "documents"), "doc_id", "text", _table(spark, sf_dir, "heldout_items"), "item_id", "text")


@_query
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from peerlens.llm.languages import mended_labels

    return mended_labels(_table(spark, sf_dir, "documents"), "doc_id", "text", "lang").select("doc_id", "seg_no", "lang")
