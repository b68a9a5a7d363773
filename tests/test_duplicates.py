import pytest

from peerlens.operators import duplicates as d
from peerlens.operators.scratch import Scratch

ITEMS = "grp string, item string, sha string, readable boolean, bits binary"


def bits(*on):
    out = bytearray(32)
    for i in on:
        out[i // 8] |= 0x80 >> (i % 8)
    return bytes(out)


BASE = range(0, 200, 3)


def made(spark, data):
    return spark.createDataFrame(data, ITEMS)


def sets(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.grp, r.root), set()).add(r["item"])
    return sorted(sorted(v) for v in out.values())


@pytest.mark.parametrize(("near", "want"), [(8, [["a", "b", "c"], ["d"]]), (0, [["a", "b"], ["c"], ["d"]])])
def test_groups(spark, near, want):
    base = set(BASE)
    df = made(spark, [("g", "a", "s1", True, bits(*base)), ("g", "b", "s1", True, bits(*base)), ("g", "c", "s2", True, bits(*(base ^ {1, 2, 4, 5}))), ("g", "d", "s3", True, bits(*(base ^ set(range(40, 80)))))])
    assert sets(d.copy_groups(df, near)) == want


def test_groups_are_apart_and_links_are_transitive(spark):
    base = set(BASE)
    chain = [("g", f"c{i}", f"s{i}", True, bits(*(base ^ set(range(1, 1 + 6 * i))))) for i in range(6)]
    other = [("h", "c0", "s0", True, bits(*base))]
    assert sets(d.copy_groups(made(spark, chain + other), 8)) == [["c0"], [f"c{i}" for i in range(6)]]


def test_representative(spark):
    df = made(spark, [("g", "a", "s", False, None), ("g", "b", "s", True, bits(1)), ("g", "c", "s", True, bits(1)), ("g", "e", "t", False, None), ("g", "f", None, False, None), ("g", "h", None, True, None)])
    got = {r["item"]: (r.rep, r.is_rep, r.size) for r in d.copy_groups(df, 8).collect()}
    assert got == {"a": ("b", False, 3), "b": ("b", True, 3), "c": ("b", False, 3), "e": ("e", True, 1), "f": ("f", True, 1), "h": ("h", True, 1)}
    reps = d.readable_representatives(df, d.copy_groups(df, 8))
    assert sorted(r["item"] for r in reps.collect()) == ["b", "h"]


def test_content_held_by_most_of_a_group_makes_few_links(spark):
    df = made(spark, [("g", f"i{i:04d}", "same", True, bits(7)) for i in range(500)])
    scratch = Scratch(spark, "t")
    links = d.copy_edges(d.numbered(df, scratch), 8, scratch).distinct()
    assert links.count() == 499
    assert sets(d.copy_groups(df, 8)) == [[f"i{i:04d}" for i in range(500)]]


def test_cross_group(spark):
    df = made(spark, [("g", "a", "s", True, None), ("g", "b", "s", True, None), ("h", "z", "s", False, None), ("k", "y", "s", True, None), ("k", "q", "t", True, None), ("k", "n", None, True, None), ("h", "n", None, True, None)])
    got = {(r.grp, r["item"]): (r.other_grp, r.other_item) for r in d.cross_group_copies(df).collect()}
    assert got == {("g", "a"): ("h", "z"), ("g", "b"): ("h", "z"), ("h", "z"): ("g", "a"), ("k", "y"): ("g", "a")}
    index = {r.sha: (r.n_items, r.n_groups) for r in d.content_index(df).collect()}
    assert index == {"s": (4, 3), "t": (1, 1)}


def test_long_chain(spark):
    """Neighbours of a chain are copies; all of it is one set, named by its first item."""
    df = made(spark, [("g", f"n{i:03d}", f"s{i}", True, bits(*range(i, i + 8))) for i in range(120)])
    got = d.copy_groups(df, 2).collect()
    assert {(r.root, r.rep, r.size) for r in got} == {("n000", "n000", 120)} and len(got) == 120


def test_empty(spark):
    assert d.copy_groups(made(spark, []), 8).count() == 0
