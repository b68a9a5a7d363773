import os

import pytest

from peerlens.operators.scratch import Scratch, shared_dir


def test_tables_live_in_the_shared_folder(spark):
    scratch = Scratch(spark, "t")
    assert scratch.root.startswith(spark.conf.get("spark.checkpoint.dir"))
    first = scratch.save(spark.range(5), "a")
    second = scratch.save(first.where("id > 2"), "b")
    scratch.drop(first, None)
    assert sorted(r.id for r in second.collect()) == [3, 4]
    root = scratch.root.removeprefix("file://")
    assert len(os.listdir(root)) == 1
    scratch.close()
    assert not os.path.exists(root)


def test_settings_are_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    Scratch(spark, "t").save(spark.range(3).repartition(2))
    assert spark.conf.get(key) == before


def test_a_cluster_must_name_the_folder():
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
