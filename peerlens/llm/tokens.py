"""Encoding of a corpus with a public byte-level BPE tokenizer.

A text is cut into pre-tokens, and the bytes of a pre-token are merged pair by
pair, the pair of the lowest rank first, the leftmost among equals.  The pairs
wait in a rank queue: one bucket per merge rank holds positions of a linked list
of parts, and a two-level bitmap of the ranks that have entries finds the next
rank by two find-first-set steps.  Entries aren't removed when a neighbouring
merge makes them stale; they are skipped when their bucket comes up.  So a merge
costs the same however long the pre-token is, where a scan for the lowest rank
would make long runs quadratic.

Ids of short pre-tokens are kept in a table of bounded size, as words recur.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Fixed value: the published pre-token pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the vocabulary files are.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-tokens remembered, and the longest that is.
REMEMBERED, LONGEST = 200_000, 48
#: Ids in one batch of the result.
BATCH_IDS = 1_000_000


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


class RankQueue:
    """Buckets of positions by rank, with a two-level bitmap of the ranks that have any."""

    WORD = 256

    def __init__(self, ranks: int):
        self.words = [0] * (-(-ranks // self.WORD))
        self.summary = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            word = rank // self.WORD
            self.words[word] |= 1 << (rank % self.WORD)
            self.summary |= 1 << word
        else:
            bucket.append(position)

    def pop_lowest(self) -> tuple[int, list[int]] | None:
        """The lowest rank and its positions from left to right, taken out; None when empty."""
        if not self.summary:
            return None
        word = (self.summary & -self.summary).bit_length() - 1
        bits = self.words[word]
        low = bits & -bits
        self.words[word] = bits ^ low
        if bits == low:
            self.summary ^= 1 << word
        rank = word * self.WORD + low.bit_length() - 1
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class Encoder:
    """Text to token ids by a vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        rank_of, queue, n = self.ranks.get, self.queue, len(piece)
        if (whole := rank_of(piece)) is not None:
            return [whole]
        # Part i begins at byte i; after[i] is the beginning of the next part and before[i] of the one before it.
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pending: list[int] = [-1] * (n + 1)
        for i in range(n - 1):
            rank = rank_of(piece[i : i + 2])
            if rank is not None:
                pending[i] = rank
                queue.push(rank, i)
        while (lowest := queue.pop_lowest()) is not None:
            rank, positions = lowest
            for at, i in enumerate(positions):
                if pending[i] != rank:
                    continue  # stale: one of the two parts has changed since
                middle = after[i]
                end = after[middle]
                after[i], pending[middle] = end, -1
                before[end] = i
                back, lower = False, rank
                new = rank_of(piece[i : after[end]]) if end < n else None
                pending[i] = -1 if new is None else new
                if new is not None:
                    queue.push(new, i)
                    lower = min(lower, new)
                if (left := before[i]) >= 0:
                    new = rank_of(piece[left:end])
                    if pending[left] == rank and new == rank:
                        back = True
                    pending[left] = -1 if new is None else new
                    if new is not None:
                        queue.push(new, left)
                        lower = min(lower, new)
                if lower < rank or back:
                    # Not in vocabularies made by merging, where a pair with a new part ranks behind it.
                    for j in positions[at + 1 :]:
                        if pending[j] == rank:
                            queue.push(rank, j)
                    break
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text; an empty text has none."""
        known, out = self.known, []
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                ids = tuple(self.merged(piece.encode()))
                if len(piece) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = ids
            out.extend(ids)
        return out


_ENCODERS: dict[int, Encoder] = {}


def _encoder(vocabulary) -> Encoder:
    """The worker's encoder for a broadcast vocabulary file; a worker keeps one."""
    key = hash(vocabulary.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(read_ranks(vocabulary.value))
    return _ENCODERS[key]


def encoded(df: DataFrame, item: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(item, ids) for every row: the token ids of its text, without special tokens.

    Null and empty texts have an empty list.  Strings of special tokens in a
    text are ordinary text.  Rows keep their number and repeats; other columns
    are ignored.  ``vocabulary`` is a file of the driver (0.8 MB here), whose
    content is broadcast.
    """
    with open(vocabulary, "rb") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content)

        def batch_of(items: list, ids: list[list[int]]) -> pa.RecordBatch:
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = np.fromiter((i for x in ids for i in x), np.int32, int(offsets[-1]))
            return pa.RecordBatch.from_arrays([pa.array(items, kind), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["item", "ids"])

        for batch in batches:
            kind = batch.schema.field(0).type
            items, ids, held = [], [], 0
            for one, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = encoder.encode(words.as_py()) if words.is_valid else []
                items.append(one)
                ids.append(found)
                held += len(found)
                if held >= BATCH_IDS:
                    yield batch_of(items, ids)
                    items, ids, held = [], [], 0
            if items:
                yield batch_of(items, ids)

    kind = df.schema[item].dataType.simpleString()
    return df.select(item, text).mapInArrow(run, f"item {kind}, ids array<int>").withColumnRenamed("item", item)
