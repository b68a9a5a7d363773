"""Results kept by content: computed once for each hash, whatever the file is called."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ContentCache:
    """A Parquet table by (tag, sha); the tag names the model and its preparation."""

    def __init__(self, spark: SparkSession, path: str, tag: str, schema: str):
        self.spark, self.path, self.tag, self.schema = spark, f"{path.rstrip('/')}/tag={tag}", tag, schema

    def read(self) -> DataFrame:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def misses(self, wanted: DataFrame) -> DataFrame:
        """One row for each sha of ``wanted`` that the cache lacks."""
        return missing(wanted, self.read())

    def fill(self, wanted: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The cache after ``compute`` has added what ``wanted`` lacks; a second run adds nothing."""
        compute(self.misses(wanted)).write.mode("append").parquet(self.path)
        return self.read()


def missing(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """One row for each non-null sha of ``wanted`` that isn't in ``cached``."""
    return wanted.where(F.col("sha").isNotNull()).dropDuplicates(["sha"]).join(cached.select("sha"), "sha", "left_anti")
