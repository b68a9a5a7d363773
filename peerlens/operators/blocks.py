"""Pairs of bit strings within a Hamming distance, over collections too large to compare.

Two strings of ``width`` bits that differ in at most ``k`` bits agree wholly in
one of any ``k + 1`` blocks.  Each string is posted once per block, under a key
of the block's number and value, which is the block table rotated so that the
block leads; a posting names the string only, so little is shuffled.

Keys that only one string has are dropped by a count that combines before its
shuffle.  A key with more than ``hot`` strings (strings that agree in a whole
block, for whatever reason, and may be a third of all) isn't paired: the bits
outside its block still differ in at most ``k`` places, so its strings are
posted again under the key and each of ``k + 1`` blocks of the rotated rest.
No level loses a pair.  After the last level the strings of one key agree in a
third of their bits and are paired, however many they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens.operators.scratch import Scratch

#: Keys with more strings than this are split by further blocks.
HOT = 256
#: Levels of further blocks; at 256 bits and k = 8 the last level's keys fix 88 bits at least.
LEVELS = 3
#: Hex digits of a string, where nothing else is said.
DIGITS = 64


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    """``parts`` ranges (start, length) that cover 0..length, as even as they can be."""
    at = [i * length // parts for i in range(parts + 1)]
    return [(at[i], at[i + 1] - at[i]) for i in range(parts)]


def _unposted(strings: DataFrame, scope: str | None) -> DataFrame:
    """The strings before any block is fixed; only strings of one scope ever share a key."""
    return strings.select("id", "fresh", F.col("hex").alias("rest"), (F.xxhash64(scope) if scope else F.lit(0).cast("long")).alias("key"))


def _posted(rows: DataFrame, digits: int, k: int) -> DataFrame:
    """A row for each block of ``rest``: its number ``n``, and ``key`` of the former key and the block."""
    posts = [F.xxhash64("key", F.lit(n), F.substring("rest", start + 1, length)) for n, (start, length) in enumerate(cuts(digits, k + 1))]
    return rows.select("id", "fresh", "rest", F.posexplode(F.array(*posts)).alias("n", "key"))


def postings(strings: DataFrame, k: int, scope: str | None = None, digits: int = DIGITS) -> DataFrame:
    """(key, id, fresh) of the first block tables; ``strings`` has id, hex of ``digits`` digits, fresh and, if given, the column ``scope``."""
    return _posted(_unposted(strings, scope), digits, k).select("key", "id", "fresh")


def _deeper(rows: DataFrame, digits: int, k: int, hot_keys: DataFrame) -> DataFrame:
    """The strings under ``hot_keys``, rotated to what their key's block leaves, all of one length.

    Where blocks are uneven the rest gives up a digit; the places that differ
    there are still ``k`` at most.
    """
    at = cuts(digits, k + 1)
    start = F.element_at(F.array(*[F.lit(s + n + 1) for s, n in at]), F.col("n") + 1)
    rest = F.substring(F.concat("rest", "rest"), start, F.lit(digits - max(n for _, n in at)))
    return _posted(rows, digits, k).join(hot_keys.select("key"), "key", "left_semi").select("id", "fresh", rest.alias("rest"), "key")


def candidate_pairs(strings: DataFrame, k: int, scratch: Scratch, *, posts: DataFrame | None = None, scope: str | None = None, hot: int = HOT, digits: int = DIGITS) -> DataFrame:
    """(a, b), a < b, of ids that share a block and of which one is fresh; a pair may come more than once.

    ``posts`` is a stored table of the first postings, if there is one;
    ``strings`` are then read only for keys that are hot.
    """
    found: list[DataFrame] = []
    rows = _unposted(strings, scope)
    posts = posts if posts is not None else postings(strings, k, scope, digits)
    for level in range(LEVELS + 1):
        counted = posts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.max("fresh").alias("any_fresh"))
        live = scratch.save(counted.where("lo < hi and any_fresh").select("key", "n", "lo", "hi"), "live-keys")
        # Most live keys have two strings, which the count names: their postings needn't meet again.
        found.append(live.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b")))
        last = level == LEVELS
        # Stored apart, so their size is known and a small table of keys is sent to the postings.
        few = scratch.save(live.where("n > 2" if last else f"n > 2 and n <= {hot}").select("key"), "shared-keys")
        shared = scratch.save(posts.join(few, "key").select("key", "id", "fresh"), "shared")
        left = shared.select("key", F.col("id").alias("a"), F.col("fresh").alias("fa"))
        right = shared.select("key", F.col("id").alias("b"), F.col("fresh").alias("fb"))
        found.append(left.join(right, "key").where("a < b and (fa or fb)").select("a", "b"))
        many = live.where(F.col("n") > hot).select("key")
        if last or many.isEmpty():
            break
        rows = scratch.save(_deeper(rows, digits, k, many), "deeper")
        digits -= max(n for _, n in cuts(digits, k + 1))
        posts = _posted(rows, digits, k).select("key", "id", "fresh")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    # Of one level a pair comes once for each block it shares, which is mostly one; further levels would multiply that.
    return pairs.distinct() if len(found) > 2 else pairs


def as_longs(bits: Column, name: str) -> list[Column]:
    """The 32 bytes as four signed 64-bit numbers."""
    return [F.conv(F.hex(F.substring(bits, 8 * i + 1, 8)), 16, -10).cast("long").alias(f"{name}{i}") for i in range(4)]


def verified(pairs: DataFrame, strings: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """Distinct (bits_a, bits_b, distance) of the candidate ids whose strings differ in at most ``k`` bits.

    ``strings`` (id, bits) may repeat rows; it is read once, for the ids that
    are candidates.  Two strings under one id are both compared.  Only numbers
    are shuffled with the pairs; the bits are made from them where they are near.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    named = strings.select("id", "bits").join(ids, "id", "left_semi").distinct().select("id", *as_longs(F.col("bits"), "x"))
    named = scratch.save(named, "named")
    at_a = named.withColumnRenamed("id", "a")
    at_b = named.select(F.col("id").alias("b"), *[F.col(f"x{i}").alias(f"y{i}") for i in range(4)])
    distance = sum((F.bit_count(F.col(f"x{i}").bitwiseXOR(F.col(f"y{i}"))) for i in range(4)), F.lit(0))
    near = pairs.join(at_a, "a").join(at_b, "b").withColumn("distance", distance).where(F.col("distance") <= k)
    bits = lambda x: F.unhex(F.concat(*[F.lpad(F.hex(f"{x}{i}"), 16, "0") for i in range(4)]))
    return near.select(bits("x").alias("bits_a"), bits("y").alias("bits_b"), "distance").distinct()
