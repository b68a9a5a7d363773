"""Every query with SQL against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
LLM = {n for n in entry.queries() if n[0] == "p" and n[1].isdigit()}
NAMES = sorted(n for n in entry.oracle_sql() if n not in LLM)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, tmp_path, name):
    entry.queries()[name](spark, DATA).write.parquet(f"{tmp_path}/got")
    duck.execute(f"CREATE OR REPLACE VIEW got AS SELECT * FROM '{tmp_path}/got/*.parquet'")
    duck.execute(f"CREATE OR REPLACE TABLE want AS {entry.oracle_sql()[name]}")
    got, want = ({r[0] for r in duck.execute(f"DESCRIBE {t}").fetchall()} for t in ("got", "want"))
    assert got == want
    columns = ", ".join(f'"{c}"' for c in sorted(got))
    for a, b in (("got", "want"), ("want", "got")):
        assert duck.execute(f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b} LIMIT 3").fetchall() == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
