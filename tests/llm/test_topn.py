import random

import pytest
from pyspark.sql import functions as F

from peerlens.llm.topn import suspicious_photos, top_n_per_group

SCHEMA = "g string, id string, x double, k long, t string"


def brute(rows, n, key):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {g: [r[1] for r in sorted(v, key=key)[:n]] for g, v in out.items()}


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.g), r.rank_no)):
        out.setdefault(r.g, []).append(r.id)
    return out


def test_equals_sorting(spark):
    rng = random.Random(0)
    rows = [(rng.choice("abc"), f"i{i:04d}", rng.choice([0.1, 0.5, -0.0, 0.0, 2.0]), rng.randrange(-3, 3), rng.choice(["p", "pq", ""])) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    want = brute(rows, 7, lambda r: (-r[2] + 0.0, r[3], r[1]))
    assert got(top_n_per_group(df, ["g"], [("x", "desc"), ("k", "asc")], "id", 7)) == want
    back = {"": 0, "p": 1, "pq": 2}
    want = brute(rows, 7, lambda r: (-back[r[4]], -r[3], r[1]))
    assert got(top_n_per_group(df, ["g"], [("t", "desc"), ("k", "desc")], "id", 7)) == want


def test_nulls_nan_and_extra_columns(spark):
    rows = [("a", "1", None, 1, "x"), ("a", "2", float("nan"), 1, "x"), ("a", "3", -1.0, 1, "x"), ("a", None, 9.0, 1, "x"), (None, "4", 1.0, 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit(1)).withColumn("__heap", F.lit("clash"))
    found = got(top_n_per_group(df, ["g"], [("x", "desc")], "id", 5, keep=["k"]))
    assert found == {"a": ["3", "1", "2"], None: ["4"]}


def test_arguments_and_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert top_n_per_group(df, ["g"], [("x", "desc")], "id", 5).count() == 0
    with pytest.raises(ValueError):
        top_n_per_group(df, ["g"], [("x", "desc")], "id", 0)
    with pytest.raises(ValueError):
        top_n_per_group(df, ["g"], [("x", "desc")], "g", 1)
    with pytest.raises(TypeError):
        top_n_per_group(df.withColumn("a", F.array("x")), ["g"], [("a", "desc")], "id", 1)


def test_a_hot_group_sends_few_rows(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("g"), F.col("id").cast("string").alias("id"), (F.col("id") % 100).cast("double").alias("x"), F.col("id").alias("k"), F.lit("").alias("t"))
    assert got(top_n_per_group(df, ["g"], [("x", "desc")], "id", 3)) == {"hot": ["100099", "100199", "100299"]}


def test_suspicious_photos(spark):
    evals = spark.createDataFrame(
        [(1, "o", "a", 0.9, None, 10), (2, "o", "a", 0.1, 0.0, 11), (3, "o", "b", 0.5, float("nan"), 5), (4, "o", "c", 0.5, -1.0, 5), (5, "o", "d", float("nan"), 0.0, 5), (6, "o", "e", 0.7, 0.0, None), (6, "o", "e", 0.7, 0.0, None), (7, None, "a", 0.9, 0.0, 1)],
        "eval_id long, outlet string, file_name string, suspicion double, z double, evaluated_at int",
    ).withColumn("evaluated_at", F.timestamp_seconds("evaluated_at"))
    flagged = "flagged_images array<struct<file_name:string,suspicion_score:double,reason:string>>"
    results = spark.createDataFrame(
        [("o", [("a", 0.2, None), ("b", 0.9, ""), None, (None, 1.0, ""), ("c", float("nan"), "")], ["x", None, "y", "x"]), ("o", [("a", 0.9, None)], ["y"]), ("p", None, None), ("p", [], [])],
        f"outlet_id string, {flagged}, ranking array<string>",
    )
    rows = {}
    for r in suspicious_photos(evals, results).collect():
        rows.setdefault((r.outlet_id, r.list_name), {})[r.rank_no] = r.file_name
    assert rows == {("o", "evals"): {1: "e", 2: "c", 3: "b", 4: "a"}, ("o", "flagged"): {1: "a", 2: "b"}, ("o", "ranking"): {1: "x", 2: "y"}}
