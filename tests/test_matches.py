import numpy as np

import __spark_entry__ as entry


def test_labels_in_pieces_and_their_neighbours(spark, tmp_path):
    """A label of more rows than n_features keeps them all, and labels needn't be 0 to 9."""
    rng = np.random.default_rng(41)
    big, small = rng.normal(size=(2300, 8)), rng.normal(size=(40, 8))
    # The rows of label 12 are those of label 3 that come after the first 2,000.
    rows = [(i, 3, v) for i, v in enumerate(big)] + [(10_000 + i, 12, v) for i, v in enumerate(big[2000:])] + [(20_000 + i, 40, v) for i, v in enumerate(small)]
    spark.createDataFrame([(i, label, [float(x) for x in v]) for i, label, v in rows], "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.a, r.b): r.inliers for r in entry.queries()["ransac_matches"](spark, str(tmp_path)).collect()}
    assert got.keys() == {("3", "3"), ("3", "3/1"), ("3/1", "3/1"), ("12", "12"), ("40", "40"), ("12", "3"), ("12", "3/1"), ("12", "40"), ("3", "40"), ("3/1", "40")}
    assert got["12", "3/1"] == got["12", "12"] == got["3/1", "3/1"] == 300 and got["3", "3"] == 2000 and got["12", "3"] < 100
