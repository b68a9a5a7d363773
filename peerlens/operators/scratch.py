"""Tables that cut lineage in iterative plans.

They are written as Parquet below the folder all executors share
(``spark.checkpoint.dir``), so a lost executor costs a re-read and nothing
more.  Only where that setting is missing (tests on one machine) a folder of
the local machine is used.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a local one for local masters only."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if found := spark.sparkContext.getCheckpointDir():
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; on a cluster it must name a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="peerlens-")
    spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def shuffle_files_end_with_the_plan(spark: SparkSession):
    """Delete the shuffle files of each plan when it ends.

    By default they stay until the driver collects its garbage, and a chain of
    tables piles them up.  A plan that has written its table needs them no more.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_AT_EXIT: list[tuple] = []


@atexit.register
def _clear() -> None:
    """Delete the folders of this application; its gateway is still open then, as it was opened before."""
    with suppress(Exception):
        for where, files in _AT_EXIT:
            files.delete(where, True)


class Scratch:
    """A private folder of intermediate tables, deleted when the application ends.

    Results may still read them lazily, so they stay until then unless dropped.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        _AT_EXIT.append(self._at(self.root))

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:04d}-{name}"

    def save(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` and return it as a fresh scan; ``drop`` takes the result."""
        path = self.path(name)
        with shuffle_files_end_with_the_plan(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables made by ``save`` that no later plan reads."""
        for t in tables:
            if path := getattr(t, "_scratch_path", None):
                self._delete(path)

    def close(self) -> None:
        self._delete(self.root)

    def _at(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        where, files = self._at(path)
        files.delete(where, True)
