import os
import random

import pytest

from peerlens.llm.tokens import PATTERN, VOCABULARY, Encoder, RankQueue, encoded, read_ranks

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def both():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = read_ranks(open(VOCABULARY, "rb").read())
    return Encoder(ranks), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_public_library(both):
    mine, public = both
    rng = random.Random(0)
    for _ in range(1500):
        text = "".join(rng.choice("abcxyzABC  \n\t'st.,!?12éñß্ক​আদি🙂👩‍👧") for _ in range(rng.randrange(120)))
        assert mine.encode(text) == public.encode_ordinary(text)


@pytest.mark.parametrize("text", ["", " ", "a", "<|endoftext|>", "ha" * 30_000, "a" * 100_001, " " * 20_000, "\n" * 999 + "x", "ক" * 9_000, "🙂" * 4_000, "abcdefghij" * 5_000])
def test_long_runs(both, text):
    assert both[0].encode(text) == both[1].encode_ordinary(text)


def test_every_token_merges_to_itself(both):
    """Merging the bytes of a token ends in that token, so looking whole pre-tokens up first changes nothing."""
    encoder = both[0]
    for token, rank in random.Random(1).sample(sorted(encoder.ranks.items()), 4000):
        if len(token) > 1:
            without = dict(encoder.ranks)
            del without[token]
            small = Encoder({t: r for t, r in encoder.ranks.items() if r < rank and len(t) <= len(token)} | {b"\0never": rank})
            assert len(small.merged(token)) == 2
            if rank > 2000:
                break


def test_vocabulary_that_was_not_merged_in_order():
    """A pair with a new part may rank before it: the queue goes back."""
    ranks = {bytes([i]): 10 + i for i in range(256)} | {b"bc": 5, b"abc": 2, b"cd": 3, b"abcd": 1}
    encoder = Encoder(ranks)

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            found = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(2)
    for _ in range(500):
        piece = bytes(rng.choice(b"abcd") for _ in range(rng.randrange(2, 12)))
        if piece not in ranks:
            assert encoder.merged(piece) == plain(piece)


def test_queue():
    queue, rng, want = RankQueue(1000), random.Random(3), {}
    for _ in range(500):
        rank, at = rng.randrange(1000), rng.randrange(50)
        queue.push(rank, at)
        want.setdefault(rank, []).append(at)
    out = []
    while (found := queue.pop_lowest()) is not None:
        out.append(found)
    assert out == [(r, sorted(want[r])) for r in sorted(want)]


def test_rows(spark, both):
    df = spark.createDataFrame([(1, "Hello world", "x"), (2, "", "x"), (3, None, "x"), (3, "again", "x"), (None, "no id", "x")], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.ids) for r in encoded(df, "doc_id", "text").collect()), key=str)
    want = sorted([(1, both[1].encode_ordinary("Hello world")), (2, []), (3, []), (3, both[1].encode_ordinary("again")), (None, both[1].encode_ordinary("no id"))], key=str)
    assert got == want and encoded(df.limit(0), "doc_id", "text").count() == 0
