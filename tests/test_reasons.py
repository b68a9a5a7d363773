import re

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.groups import axis, between, turned_fan


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Eight groups with two odd items each, one with four items of another place, a pair that doesn't match, a copy and an unreadable item."""
    rng = np.random.default_rng(31)
    groups = {f"g{g}": turned_fan(rng, 8, 0.94, strangers=2) for g in range(8)}
    groups |= {"mixed": np.vstack([turned_fan(rng, 10, 0.94), turned_fan(rng, 4, 0.94)])}
    groups["pair"] = np.stack([axis(0), between(axis(0), axis(1), 0.03)])
    images = [(g, f"i{k:02d}", f"{g}-{k}", True, None) for g, vs in groups.items() for k in range(len(vs))] + [("g0", "copy", "g0-0", True, None), ("g1", "broken", "x", False, None)]
    vectors = [(f"{g}-{k}", "dinov2", [float(x) for x in v]) for g, vs in groups.items() for k, v in enumerate(vs)]
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(images, "outlet string, file_name string, sha256 string, readable boolean, dhash binary").write.parquet(f"{at}/images.parquet")
    spark.createDataFrame(vectors, "sha256 string, model string, vec array<float>").write.parquet(f"{at}/image_vectors.parquet")
    return at


def test_every_flagged_item_has_its_reason(spark, tables):
    import duckdb

    got = {(r.grp, r["item"]): (r.kind, r.reason) for r in entry.queries()["flagged_reasons"](spark, tables).collect()}
    con = duckdb.connect()
    for name in ("images", "image_vectors"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet/*.parquet'")
    sql = entry.oracle_sql()["flagged_reasons"]
    assert got == {(g, i): (kind, reason) for g, i, kind, reason in con.execute(f"SELECT grp, item, kind, reason FROM ({sql})").fetchall()}
    assert {kind for kind, _ in got.values()} == {"scored", "pair", "duplicate", "unreadable"}
    statistic = r"Median similarity to peers -?\d\.\d\d vs folder median \d\.\d\d \(modified z = -\d+\.\d; absolute floor -?\d\.\d\d\)\."
    assert all(re.fullmatch(statistic, got[f"g{g}", f"i{k:02d}"][1]) for g in range(8) for k in (8, 9))
    assert all("3 other images in this folder resemble it" in got["mixed", f"i{k}"][1] for k in (10, 11, 12, 13))
    assert all("do not match each other (similarity" in got["pair", i][1] for i in ("i00", "i01"))
