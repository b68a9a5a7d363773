"""The history of accepted records: retries, failures between its writes, and what a call reads."""

import random

import pytest

from peerlens.llm import increments
from peerlens.llm.increments import History
from peerlens.llm.photos import photo_records
from peerlens.operators.scratch import Scratch
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tests.llm.test_near import IMAGES, crowd, want_cases


ROWS = crowd(11, 120, batches=2)


@pytest.fixture
def records(spark):
    return Scratch(spark, "t").save(photo_records(spark.createDataFrame(ROWS, IMAGES)), "records")


def admitted(history, records, batch, spark):
    rows = history.admit(Scratch(spark, "t").save(records.where(F.col("batch_no") == batch)), Scratch(spark, "t")).collect()
    return sorted((r.earlier_id, r.image_id) for r in rows)


def test_a_repeated_call_gives_the_same_and_writes_nothing(spark, records, tmp_path):
    history = History(spark, f"file://{tmp_path}/h")
    first = [admitted(history, records, b, spark) for b in range(2)]
    before = sorted((p, p.stat().st_mtime_ns) for p in tmp_path.rglob("*.parquet"))
    assert [admitted(history, records, b, spark) for b in range(2)] == first
    assert sorted((p, p.stat().st_mtime_ns) for p in tmp_path.rglob("*.parquet")) == before
    assert sorted(x for part in first for x in part) == want_cases(ROWS)


@pytest.mark.parametrize("fails", ["blocks", "marker"])
def test_a_call_that_fails_between_its_writes_is_just_repeated(spark, records, tmp_path, monkeypatch, fails):
    history = History(spark, f"file://{tmp_path}/h")
    first = admitted(history, records, 0, spark)
    real = DataFrameWriter.parquet

    def parquet(self, path, *more, **named):
        if "/blocks/commit=1" in path:
            raise OSError("lost")
        real(self, path, *more, **named)

    def put(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(*((DataFrameWriter, "parquet", parquet) if fails == "blocks" else (increments._Files, "put", put)))
        with pytest.raises(OSError):
            admitted(history, records, 1, spark)
    assert len(history.commits()) == 1 and (tmp_path / "h" / "prints").exists()
    again = first + [x for b in (1,) for x in admitted(history, records, b, spark)]
    assert sorted(again) == want_cases(ROWS)


def test_batches_come_in_their_order(spark, records, tmp_path):
    history = History(spark, f"file://{tmp_path}/h")
    admitted(history, records, 1, spark)
    with pytest.raises(ValueError):
        admitted(history, records, 0, spark)
    with pytest.raises(ValueError):
        admitted(history, records.where("image_id % 2 = 0"), 1, spark)
    with pytest.raises(ValueError):
        History(spark, f"file://{tmp_path}/h", max_distance=4).commits()


def test_a_call_reads_the_parts_its_keys_fall_in(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(increments, "LEAST_PARTS", 64)
    rng = random.Random(5)
    rows = [(i, 0, f"s{i}", rng.randbytes(32), "") for i in range(2000)] + [(5000, 1, "s7", rng.randbytes(32), "")]
    records = Scratch(spark, "t").save(photo_records(spark.createDataFrame(rows, IMAGES)), "records")
    history = History(spark, f"file://{tmp_path}/h")
    history.accept(records.where("batch_no = 0"))
    asked = {}
    real = History.read

    def read(self, name, commits=None, parts=None):
        out = real(self, name, commits, parts)
        asked[name] = out.select(F.input_file_name()).distinct().count()
        return out

    monkeypatch.setattr(History, "read", read)
    assert admitted(history, records, 1, spark) == [(7, 5000)]
    held = {name: len(list((tmp_path / "h" / name).rglob("*.parquet"))) for name in ("blocks", "contents", "prints")}
    assert held["blocks"] >= 64 and asked["blocks"] <= 9 and asked["contents"] == 1 and asked["prints"] <= 9
    assert "records" not in asked


def test_empty_calls(spark, records, tmp_path):
    history = History(spark, f"file://{tmp_path}/h")
    assert admitted(history, records, 77, spark) == [] and history.commits() == [] and history.records().count() == 0
    assert admitted(history, spark.createDataFrame([(9, 0, None, None)], records.schema), 0, spark) == []
    assert admitted(history, spark.createDataFrame([(10, 1, None, None)], records.schema), 1, spark) == []
    assert history.records().count() == 2
