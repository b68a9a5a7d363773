import random

import pytest

from peerlens.operators.components import connected_components
from peerlens.operators.scratch import Scratch
from peerlens.operators.skew import join_to_one


def union_find(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        up[find(a)] = find(b)
    out = {}
    for x in up:
        out.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, out.values()))


def parts(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.root, set()).add(r.node)
        assert r.root is not None
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("hot", [1_000_000, 20])
@pytest.mark.parametrize("kind", ["random", "chain", "hub"])
def test_equals_union_find(spark, kind, hot):
    """The hub has a third of all edges; with ``hot`` at 20 its rows go by broadcast labels."""
    rng = random.Random(4)
    edges = {
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(300)],
        "chain": [(i, i + 1) for i in range(300)],
        "hub": [(0, i) for i in range(1, 150)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(300)],
    }[kind]
    df = spark.createDataFrame(edges + edges[:20], "a long, b long")
    want = [p for p in union_find([(a, b) for a, b in edges if a != b])]
    assert parts(connected_components(df, "a", "b", Scratch(spark, "t"), hot)) == want


def test_nothing_to_link(spark):
    df = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "a long, b long")
    assert connected_components(df, "a", "b", Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_lose_nothing(spark, how):
    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(90)], "k long, x long")
    ones = spark.createDataFrame([(k, k * 10) for k in range(0, 90, 2)], "k long, y long")
    scratch = Scratch(spark, "t")
    got, want = (sorted(map(tuple, join_to_one(rows, ones, ["k"], scratch, how, hot).collect()), key=str) for hot in (5, 1000))
    assert got == want and len(got) == (90 if how == "left" else 75)
