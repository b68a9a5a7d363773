import random

import numpy as np
import pytest

from peerlens.llm.increments import History, repeated_photos
from peerlens.llm import paritysketch
from peerlens.llm.paritysketch import BLOCK_BITS, bit_sketches, near_sets, photo_pairs, sketch_bits, sketches, token_bits
from peerlens.llm.photos import photo_records
from peerlens.operators.blocks import candidate_pairs, verified
from peerlens.operators.scratch import Scratch
from pyspark.sql import functions as F


def near_photos(df):
    return photo_pairs(paritysketch.near_photos(df))


IMAGES = "image_id long, batch_no int, sha256 string, dhash binary, hex string"


def flipped(bits: bytes, places) -> bytes:
    out = bytearray(bits)
    for p in places:
        out[p // 8] ^= 0x80 >> (p % 8)
    return bytes(out)


def distance(a: bytes, b: bytes) -> int:
    return bin(int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).count("1")


def crowd(seed: int, n: int, batches: int = 4):
    rng = random.Random(seed)
    bases = [rng.randbytes(32) for _ in range(max(2, n // 8))]
    rows = []
    for i in range(1, n + 1):
        bits = flipped(rng.choice(bases), rng.sample(range(256), rng.randrange(12)))
        bits = rng.choice([bits] * 12 + [None, b"\0" * 32, bits[:16]])
        rows.append((i, i * batches // (n + 1), rng.choice([f"s{rng.randrange(n)}"] * 9 + [None]), bits, "clash"))
    return rows


def usable(b):
    return b is not None and len(b) == 32 and any(b)


def want_pairs(rows):
    use = [r for r in rows if usable(r[3])]
    return sorted((a[0], b[0]) for i, a in enumerate(use) for b in use[i + 1 :] if distance(a[3], b[3]) <= 8 and (a[2] is None or b[2] is None or a[2] != b[2]))


def want_cases(rows):
    accepted, cases = [], []
    for batch in sorted({r[1] for r in rows}):
        new = []
        for r in (r for r in rows if r[1] == batch):
            same = [a[0] for a in accepted if (a[2] is not None and a[2] == r[2]) or (usable(a[3]) and usable(r[3]) and distance(a[3], r[3]) <= 8)]
            cases.append((min(same), r[0])) if same else new.append(r)
        accepted += new
    return sorted(cases)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_photos_equals_brute_force(spark, seed):
    rows = crowd(seed, 400)
    got = near_photos(spark.createDataFrame(rows, IMAGES).repartition(5)).collect()
    assert sorted((r.image_id_a, r.image_id_b) for r in got) == want_pairs(rows)


def test_edge_distances(spark):
    base = random.Random(3).randbytes(32)
    rows = [(1, 0, "a", base, "")] + [(10 + d, 0, f"x{d}", flipped(base, range(0, 256, 256 // d)[:d]), "") for d in range(1, 13)]
    got = {r.image_id_b for r in near_photos(spark.createDataFrame(rows, IMAGES)).collect() if r.image_id_a == 1}
    assert got == {10 + d for d in range(1, 9)}


def test_hot_hash_of_one_content(spark):
    base = random.Random(5).randbytes(32)
    rows = [(i, 0, "same", base, "") for i in range(1, 400)] + [(1000, 0, "other", base, ""), (1001, 0, None, base, "")]
    got = near_photos(spark.createDataFrame(rows, IMAGES))
    assert got.count() == 399 + 399 + 1


@pytest.mark.parametrize("hot", [2, 256])
def test_hot_blocks_lose_nothing(spark, hot):
    rng = random.Random(9)
    shared = rng.randbytes(12)
    strings = [shared + flipped(rng.choice([b"\1" * 20, b"\7" * 20, b"\x55" * 20]), rng.sample(range(160), rng.randrange(14))) for _ in range(150)]
    strings = sorted(set(strings))
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "id long, bits binary").withColumn("hex", F.hex("bits")).withColumn("fresh", F.lit(True))
    scratch = Scratch(spark, "t")
    found = verified(candidate_pairs(df, 8, scratch, hot=hot), df, 8, scratch).collect()
    want = {(a, b) for i, a in enumerate(strings) for b in strings[i + 1 :] if distance(a, b) <= 8}
    assert {tuple(sorted((bytes(r.bits_a), bytes(r.bits_b)))) for r in found} == want


def test_sketches_bound_the_difference():
    """Tokens fold onto fewer bits, and the distance of the sketches is never above the difference of the sets, and of its parity."""
    rng = np.random.default_rng(0)
    for universe, k in ((256, 8), (5000, 2)):
        every = np.arange(universe)
        for bits in (token_bits(every, k), token_bits(every, k, universe)):
            assert len(set(bits.tolist())) < universe and bits.max() < sketch_bits(k)
        member = (rng.random((40, universe)) < 0.4).astype(np.uint8)
        dealt = np.bincount(token_bits(every, k, universe) // BLOCK_BITS)
        assert dealt.max() - dealt.min() <= 1
        flat = sketches(np.nonzero(member)[1], member.sum(1, dtype=np.int64), k)
        for packed in (np.unpackbits(flat, axis=1), np.unpackbits(bit_sketches(member, k), axis=1)):
            for i in range(0, 40, 2):
                apart, shown = int((member[i] ^ member[i + 1]).sum()), int((packed[i] ^ packed[i + 1]).sum())
                assert shown <= apart and (apart - shown) % 2 == 0


def test_texts_with_insertions_and_reordering(spark):
    """Sets of words of any number, edited by insertion, deletion, replacement and shuffling, against all pairs."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(4000)]
    texts = []
    for _ in range(40):
        base = rng.sample(vocabulary, rng.randrange(2, 90))
        for _ in range(6):
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words)) : rng.choice([0, None])] = [rng.choice(vocabulary)] if rng.random() < 0.1 else []
                words.insert(rng.randrange(len(words) + 1), rng.choice(vocabulary))
            rng.shuffle(words)
            texts.append(words)
    texts += [[], ["one"], ["one", None, "one"], vocabulary[:7], None]
    df = spark.createDataFrame([(i, w, "clash") for i, w in enumerate(texts)], "doc long, words array<string>, class string")
    near = near_sets(df, "doc", "words", 6)
    names = {r["class"]: set() for r in near.members.collect()}
    for r in near.members.collect():
        names[r["class"]].add(r["doc"])
    sets = [None if t is None else frozenset(w for w in t if w) for t in texts]
    got = {frozenset((sets[min(names[r.class_a])], sets[min(names[r.class_b])])): r.difference for r in near.links.collect()}
    want = {frozenset((a, b)): len(a ^ b) for a in set(sets) - {None} for b in set(sets) - {None} if a != b and len(a ^ b) <= 6}
    assert len(want) > 50 and got == want and sum(map(len, names.values())) == len(texts) - 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_increments_equal_brute_force(spark, seed):
    rows = crowd(seed, 300)
    got = repeated_photos(spark.createDataFrame(rows, IMAGES).repartition(5)).collect()
    assert sorted((r.earlier_id, r.image_id) for r in got) == want_cases(rows)


def test_a_call_for_each_batch_is_the_same(spark, tmp_path):
    rows = crowd(7, 240)
    scratch = Scratch(spark, "t")
    records = scratch.save(photo_records(spark.createDataFrame(rows, IMAGES)), "records")
    history = History(spark, f"file://{tmp_path}/history")
    got = []
    for batch in range(4):
        got += [(r.earlier_id, r.image_id) for r in history.admit(scratch.save(records.where(F.col("batch_no") == batch)), scratch).collect()]
    assert sorted(got) == want_cases(rows)
    assert history.records().count() == len(rows) - len(got)


def test_nothing(spark):
    empty = spark.createDataFrame([], IMAGES)
    assert near_photos(empty).count() == 0 and repeated_photos(empty).count() == 0
    nulls = spark.createDataFrame([(None, 0, "a", None, ""), (1, None, None, None, ""), (2, None, None, None, "")], IMAGES)
    assert near_photos(nulls).count() == 0 and repeated_photos(nulls).count() == 0
