from peerlens.llm.components import photo_groups

IMAGES = "image_id long, batch_no int, sha256 string, dhash binary, extra string"
PAIRS = "sha256_a string, sha256_b string, method string, verdict string"


def test_photo_groups(spark):
    images = spark.createDataFrame(
        [(1, 0, "AA", None, ""), (2, 0, " aa\n", None, ""), (3, 1, "bb", None, ""), (3, 2, "zz", None, ""), (4, 0, None, None, ""), (5, 0, None, None, ""), (6, 0, "cc", None, ""), (7, 0, "dd", None, ""), (8, 0, "ee", None, ""), (None, 0, "aa", None, ""), (9, 0, "", None, ""), (10, 0, " ", None, "")],
        IMAGES,
    )
    pairs = spark.createDataFrame(
        [("aa", "BB ", "sift", " Match"), ("bb", "aa", "dhash", "no_match"), ("cc", "dd", "x", "no_match"), ("cc", "unknown", "x", "match"), ("unknown", "dd", "x", "match"), ("ee", "ee", "x", "match"), (None, "cc", "x", "match"), ("cc", "ee", "x", None)],
        PAIRS,
    )
    got = sorted((r.group_id, r.image_id) for r in photo_groups(images, pairs).collect())
    assert got == [(1, 1), (1, 2), (1, 3), (9, 9), (9, 10)]


def test_hot_hash_and_empty(spark):
    images = spark.createDataFrame([(i, 0, "same" if i % 3 else f"s{i}", None, "") for i in range(1, 900)], IMAGES)
    none = spark.createDataFrame([], PAIRS)
    got = photo_groups(images, none)
    assert got.count() == sum(1 for i in range(1, 900) if i % 3) and {r.group_id for r in got.collect()} == {1}
    assert photo_groups(spark.createDataFrame([], IMAGES), none).count() == 0
