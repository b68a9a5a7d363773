"""The pN_ queries on the smallest tables, against DuckDB or brute force."""

import os

import numpy as np
import pytest

from peerlens.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
COLUMNS = {
    "p1_found": {"outlet_id", "list_name", "rank_no", "file_name"}, "p2_found": {"group_id", "image_id"}, "p3_found": {"vec_id_a", "vec_id_b"}, "p4_found": {"earlier_id", "image_id"},
    "p5_found": {"image_id_a", "image_id_b"}, "p6_ids": {"doc_id", "ids"}, "p7_found": {"doc_id", "item_id"}, "p8_found": {"doc_id", "seg_no", "lang"},
}


def test_names():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, tmp_path, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    QUERIES[name](spark, DATA).write.parquet(f"{tmp_path}/got")
    con.execute(f"CREATE VIEW got AS SELECT * FROM '{tmp_path}/got/*.parquet'")
    con.execute(f"CREATE TABLE want AS {ORACLE[name]}")
    columns = ", ".join(sorted(COLUMNS[name]))
    assert con.execute("SELECT count(*) FROM got").fetchall()[0][0] > 0
    for a, b in (("got", "want"), ("want", "got")):
        assert con.execute(f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b} LIMIT 3").fetchall() == []


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(ORACLE)))
def test_columns(spark, name):
    assert set(QUERIES[name](spark, DATA).columns) == COLUMNS[name]


def test_p3_recall(spark):
    rows = spark.read.parquet(f"{DATA}/image_vectors.parquet").where("model = 'dinov2' and size(vec) = 64").select("vec_id", "vec").collect()
    v = {r.vec_id: np.array(r.vec) for r in rows if None not in r.vec and np.isfinite(r.vec).all() and np.any(r.vec)}
    ids = sorted(v)
    m = np.stack([v[i] / np.linalg.norm(v[i]) for i in ids])
    s = m @ m.T
    np.fill_diagonal(s, -2)
    want = {tuple(sorted((ids[i], ids[j]))) for i in range(len(ids)) for j in np.argsort(-s[i])[:5] if s[i, j] >= 0.9}
    got = {(r.vec_id_a, r.vec_id_b) for r in QUERIES["p3_found"](spark, DATA).collect()}
    assert want and len(want & got) / len(want) >= 0.9 and len(got - want) <= 0.05 * len(want)


def test_p6_equals_public_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    from peerlens.llm.tokens import PATTERN, VOCABULARY, read_ranks

    public = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(open(VOCABULARY, "rb").read()), special_tokens={})
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r.ids for r in QUERIES["p6_ids"](spark, DATA).collect()}
    assert got == {i: public.encode_ordinary(t or "") for i, t in texts.items()}
