"""Incremental runs: new items arrive as a stream, and only the groups they touch are scored again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from peerlens.config import Consensus
from peerlens.operators import consensus


def rescored(all_items: DataFrame, arrived: DataFrame, how: Consensus | None = None) -> DataFrame:
    """Consensus and z of the groups of ``all_items`` (grp, item, vec) that ``arrived`` touches."""
    touched = arrived.select("grp").distinct()
    return consensus.modified_z(consensus.consensus(all_items.join(touched, "grp", "left_semi"), how=how))


def rescoring(spark: SparkSession, stream: DataFrame, store: str, sink: Callable[[DataFrame, int], None], how: Consensus | None = None) -> DataStreamWriter:
    """A writer that adds each batch of (grp, item, vec) to the Parquet ``store`` and hands the touched groups' scores to ``sink``.

    A batch that is delivered again after a failure replaces its own part of
    the store (a folder per batch), so it counts once.
    """
    def batch(df: DataFrame, number: int) -> None:
        df.select("grp", "item", "vec").write.mode("overwrite").parquet(f"{store.rstrip('/')}/batch={number}")
        known = spark.read.option("recursiveFileLookup", True).schema("grp string, item string, vec array<double>").parquet(store)
        arrived = spark.read.schema("grp string, item string, vec array<double>").parquet(f"{store.rstrip('/')}/batch={number}")
        one = known.groupBy("grp", "item").agg(F.min("vec").alias("vec"))
        sink(rescored(one, arrived, how), number)

    return stream.writeStream.foreachBatch(batch)
