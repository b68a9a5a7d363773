"""Near-duplicate records with small edits.

A record is a set of tokens; records are near when their sets differ in at most
``k`` tokens, whatever the order of the tokens.  Each token is hashed to a bit
of a sketch and the bits are combined by XOR, so the sketch keeps parities: a
token that both sets have leaves both sketches alike, and the Hamming distance
of two sketches never exceeds the symmetric difference of the sets.  Sets that
are near also have sizes within ``k``.  So records are joined by pigeonhole:
sketches of one size band that agree in one of ``k + 1`` blocks are candidates,
and the candidates are verified on the sets themselves.

Equal sets are one class.  The join gives links between classes and who is in
which class; links between records are for the caller to expand.

The tokens of a photo are the positions of the set bits of its dhash, so the
symmetric difference is the Hamming distance of the hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.llm.photos import photo_records
from peerlens.operators.blocks import candidate_pairs, verified
from peerlens.operators.scratch import Scratch

#: Bits of each block of a sketch: enough that few of a block's tokens fold, as each that does makes more candidates.
BLOCK_BITS = 256


class Near(NamedTuple):
    """Links between classes of equal records, and the classes of the records."""

    links: DataFrame
    members: DataFrame


def sketch_bits(k: int) -> int:
    return BLOCK_BITS * (k + 1)


def _mixed(tokens: np.ndarray) -> np.ndarray:
    x = tokens.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def token_bits(tokens: np.ndarray, k: int, universe: int = 0) -> np.ndarray:
    """The sketch bit of each token, given as 64-bit numbers: a block, and a hashed bit in it.

    The block is hashed too; tokens below a small ``universe`` are dealt to the
    blocks in the order of their hash, so that no block gets fewer than others.
    """
    x = _mixed(tokens)
    block = x % np.uint64(k + 1)
    if universe:
        dealt = np.empty(universe, np.uint64)
        dealt[np.argsort(_mixed(np.arange(universe)), kind="stable")] = np.arange(universe) % (k + 1)
        block = dealt[tokens]
    return (block * np.uint64(BLOCK_BITS) + (x >> np.uint64(20)) % np.uint64(BLOCK_BITS)).astype(np.int64)


def sketches(tokens: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Packed parity sketches (record, byte) of sets, given as their tokens one after another and their sizes."""
    bits = sketch_bits(k)
    at = np.repeat(np.arange(len(sizes)) * bits, sizes) + token_bits(tokens, k)
    parity = np.bincount(at, minlength=len(sizes) * bits).astype(np.uint8) & 1
    return np.packbits(parity.reshape(len(sizes), bits), axis=1)


def bit_sketches(sets: np.ndarray, k: int) -> np.ndarray:
    """The same of the rows of a 0/1 matrix (record, token)."""
    out = np.zeros((sketch_bits(k), len(sets)), np.uint8)
    for token, bit in enumerate(token_bits(np.arange(sets.shape[1]), k, sets.shape[1])):
        out[bit] ^= sets[:, token]
    return np.packbits(out.T, axis=1)


def _of_elements(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    return sketches(column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), sizes, k), sizes


def _of_set_bits(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    sets = np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1), axis=1)
    return bit_sketches(sets, k), sets.sum(1, dtype=np.int64)


def _sketched(sketch: Callable[[pa.Array, int], tuple[np.ndarray, np.ndarray]], k: int, step: int = 2048):
    """Rows (id, sketch, size) of rows (id, set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                packed, sizes = sketch(part.column(1), k)
                fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(packed.shape[1]), len(packed), [None, pa.py_buffer(packed.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), fixed.cast(pa.binary()), pa.array(sizes.astype(np.int32))], names=["id", "sketch", "size"])

    return run


def _candidates(sketched: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """(a, b) of the ids of ``sketched`` (id, sketch, size) that share a size band and a block of their sketches."""
    wide = 4 * max(k, 1)
    band = F.floor((F.col("size") + wide // 2) / wide).cast("int")
    # The top k sizes of a band also stand in the next one, where records of up to k more tokens are.
    both = F.when((F.col("size") + wide // 2) % wide >= wide - k, F.array(band, band + 1)).otherwise(F.array(band))
    banded = sketched.select("id", F.hex("sketch").alias("hex"), F.lit(True).alias("fresh"), F.explode(both).alias("band"))
    return candidate_pairs(banded, k, scratch, scope="band", digits=sketch_bits(k) // 4)


def near_sets(df: DataFrame, item: str, tokens: str, k: int) -> Near:
    """Links (class_a, class_b, difference) of different sets of up to ``k`` tokens in difference, and members (item, class).

    ``tokens`` is an array of any type that can be hashed; repeated and null
    tokens don't count and their order is of no matter.  Null arrays and null
    items are left out; an empty array is an empty set.  A class is named by
    a 64-bit hash of its set.  Exact: every pair within ``k`` is linked.
    """
    spark = df.sparkSession
    scratch, inner = Scratch(spark, "near-sets"), Scratch(spark, "near-sets-join")
    marks = F.array_sort(F.array_distinct(F.transform(F.filter(tokens, lambda t: t.isNotNull()), lambda t: F.xxhash64(t))))
    named = df.where(F.col(item).isNotNull() & F.col(tokens).isNotNull()).select(F.col(item).alias("item"), marks.alias("set")).withColumn("class", F.xxhash64("set"))
    members = scratch.save(named.select("item", "class", "set"), "members")
    sets = inner.save(members.groupBy(F.col("class").alias("id")).agg(F.min("set").alias("set")), "sets")
    sketched = sets.mapInArrow(_sketched(_of_elements, k), "id long, sketch binary, size int")
    pairs = _candidates(sketched, k, inner).distinct()
    at_a = sets.select(F.col("id").alias("a"), F.col("set").alias("sa"))
    at_b = sets.select(F.col("id").alias("b"), F.col("set").alias("sb"))
    apart = F.size("sa") + F.size("sb") - 2 * F.size(F.array_intersect("sa", "sb"))
    found = pairs.join(at_a, "a").join(at_b, "b").select(F.col("a").alias("class_a"), F.col("b").alias("class_b"), apart.alias("difference"))
    links = scratch.save(found.where(F.col("difference") <= k), "links")
    inner.close()
    return Near(links, members.select(F.col("item").alias(item), "class"))


def near_fingerprints(records: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """(bits_a, bits_b, distance) of every pair of different fingerprints (column ``bits``, 32 bytes) that differ in at most ``k`` bits."""
    inner = Scratch(records.sparkSession, "near-join")
    named = inner.save(records.where(F.col("bits").isNotNull()).select(F.xxhash64("bits").alias("id"), "bits").distinct(), "fingerprints")
    # Sketches are larger than the fingerprints, so they are made again where they are read.
    sketched = named.mapInArrow(_sketched(_of_set_bits, k), "id long, sketch binary, size int")
    near = scratch.save(verified(_candidates(sketched, k, inner), named, k, inner), "near")
    inner.close()
    return near


def near_photos(images: DataFrame, k: int = 8) -> Near:
    """Links (bits_a, bits_b, distance) of near dhash values, and members (bits, sha, image_id) of the classes of one dhash.

    Unusable dhash values are near to nothing and have no class.  A record
    delivered again counts once; a null sha256 equals nothing, so such records
    get a sha of their own.  An empty table gives no links; other columns are
    ignored.
    """
    scratch = Scratch(images.sparkSession, "near")
    records = photo_records(images).where(F.col("bits").isNotNull())
    own = F.coalesce(F.col("sha"), F.concat(F.unhex(F.lit("00")), F.col("image_id").cast("string").cast("binary")))
    members = scratch.save(records.select("bits", own.alias("sha"), "image_id"), "records")
    return Near(near_fingerprints(members, k, scratch), members)


def photo_pairs(near: Near) -> DataFrame:
    """(image_id_a, image_id_b), a < b, of every pair of records with near dhash values and different sha256 values.

    Pairs of one sha256 are sorted out on classes of one (dhash, sha256), before
    records are named.
    """
    links, records = near
    scratch = Scratch(records.sparkSession, "pairs")
    # Fingerprints held under more than one sha are near to themselves.
    mixed = records.groupBy("bits").agg(F.min("sha").alias("lo"), F.max("sha").alias("hi")).where("lo <> hi").select(F.col("bits").alias("bits_a"), F.col("bits").alias("bits_b"))
    linked = scratch.save(links.select("bits_a", "bits_b").unionByName(mixed), "linked")
    wanted = linked.select(F.explode(F.array("bits_a", "bits_b")).alias("bits")).distinct()
    members = scratch.save(records.join(wanted, "bits", "left_semi"), "members")
    classes = scratch.save(members.select("bits", "sha").distinct(), "classes")
    at_a = classes.select(F.col("bits").alias("bits_a"), F.col("sha").alias("sha_a"))
    at_b = classes.select(F.col("bits").alias("bits_b"), F.col("sha").alias("sha_b"))
    pairs = linked.join(at_a, "bits_a").join(at_b, "bits_b")
    pairs = pairs.where("sha_a <> sha_b and (bits_a <> bits_b or sha_a < sha_b)")
    in_a = members.select(F.col("bits").alias("bits_a"), F.col("sha").alias("sha_a"), F.col("image_id").alias("a"))
    in_b = members.select(F.col("bits").alias("bits_b"), F.col("sha").alias("sha_b"), F.col("image_id").alias("b"))
    found = pairs.join(in_a, ["bits_a", "sha_a"]).join(in_b, ["bits_b", "sha_b"])
    return found.select(F.least("a", "b").alias("image_id_a"), F.greatest("a", "b").alias("image_id_b"))
