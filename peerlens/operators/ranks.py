"""Exact order statistics of similarities in groups too large for one tile.

A similarity is placed on a fine scale of whole numbers that keeps its order.
For each asking item the values at two ranks are narrowed down together over all
its tiles: each pass counts the values per next digit of that scale among those
that share the digits found so far, and the counts summed over the tiles pick
the digits.  The first pass also tells how many values there are, so the ranks
may depend on that.  What is left after the last digit is sent as (value,
count), so values that repeat cost nothing.  With two digits these are three
passes over the tiles, and a fourth for a mean between the ranks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peerlens.operators.scratch import Scratch
from peerlens.operators.tiles import Tile, Tiling, each_tile, kind_of

#: Bits of a digit, and digits that are counted before values are sent.
BITS, ROUNDS = 6, 2
_SPAN = 1.0 + 1e-6


def _scale(sim: np.ndarray) -> np.ndarray:
    """Whole numbers of ``ROUNDS`` digits in the order of the similarities; -1 for NaN."""
    top = 1 << (BITS * ROUNDS)
    with np.errstate(invalid="ignore"):
        at = np.floor((np.clip(sim, -_SPAN, _SPAN) + _SPAN) / (2 * _SPAN) * top)
    return np.where(np.isnan(at), -1, np.minimum(at, top - 1)).astype(np.int64)


def _numbers(tile: Tile, name: str, rows: np.ndarray) -> np.ndarray:
    return tile.column(name, rows).to_numpy(zero_copy_only=False).astype(np.int64)


def _counts(at: np.ndarray, prefix: np.ndarray, shift: int) -> list[np.ndarray]:
    """For each row the number of values per digit above ``shift``, of those whose higher digits are its prefix."""
    digits = 1 << BITS
    alike = (at >= 0) & (at >> (shift + BITS) == prefix[:, None])
    flat = (((at >> shift) & (digits - 1)) + np.arange(len(at))[:, None] * digits)[alike]
    return list(np.bincount(flat, minlength=len(at) * digits).reshape(len(at), digits))


def _first_digit(best):
    def run(tile: Tile) -> pa.Table | None:
        parts = []
        for rows, sim in tile.similarities():
            counts = _counts(_scale(sim), np.zeros(len(rows), np.int64), BITS * (ROUNDS - 1))
            parts.append(pa.table({"grp": tile.column("grp", rows), "item": tile.column("item", rows), "counts": pa.array(counts, pa.list_(pa.int64())), "top": best(tile, sim)}))
        return pa.concat_tables(parts) if parts else None

    return run


def _next_digit(round_no: int):
    shift = BITS * (ROUNDS - 1 - round_no)

    def run(tile: Tile) -> pa.Table | None:
        parts = []
        for rows, sim in tile.similarities():
            at, pa_, pb = _scale(sim), _numbers(tile, "pa", rows), _numbers(tile, "pb", rows)
            low = _counts(at, pa_, shift)
            # Adjacent ranks mostly share their digits.
            high = low if (pa_ == pb).all() else _counts(at, pb, shift)
            parts.append(pa.table({"grp": tile.column("grp", rows), "item": tile.column("item", rows), "ca": pa.array(low, pa.list_(pa.int64())), "cb": pa.array(high, pa.list_(pa.int64()))}))
        return pa.concat_tables(parts) if parts else None

    return run


def _values(tile: Tile) -> pa.Table | None:
    who, value, times, place = [], [], [], []
    for rows, sim in tile.similarities():
        at, low, high = _scale(sim), _numbers(tile, "pa", rows), _numbers(tile, "pb", rows)
        alike = (at == low[:, None]) | (at == high[:, None])
        for i, r in enumerate(rows):
            v, n = np.unique(sim[i][alike[i]], return_counts=True)
            who.append(np.full(len(v), r))
            value.append(v)
            times.append(n)
            place.append(_scale(v))
    if not who:
        return None
    at = np.concatenate(who)
    return pa.table({
        "grp": tile.column("grp", at), "item": tile.column("item", at), "place": pa.array(np.concatenate(place)),
        "value": pa.array(np.concatenate(value)), "times": pa.array(np.concatenate(times).astype(np.int64)),
    })


def _walk(counts: str, rank: str) -> Column:
    """Along the digits up to the one that holds the rank: (below, digit)."""
    return F.expr(f"""aggregate({counts}, named_struct('below', 0L, 'digit', 0L, 'done', false), (t, c) ->
        IF(t.done OR t.below + c > {rank}, named_struct('below', t.below, 'digit', t.digit, 'done', true),
           named_struct('below', t.below + c, 'digit', t.digit + 1L, 'done', false)))""")


def _summed(column: str) -> Column:
    return F.array(*[F.sum(F.col(column)[i]) for i in range(1 << BITS)])


def values_at_ranks(
    tiling: Tiling, ranks: Callable[[Column], tuple[Column, Column]], best: Callable[[Tile, np.ndarray], pa.Array], scratch: Scratch, strangers: bool = False, floor: float | None = None,
) -> DataFrame:
    """(grp, item, n, top, a, b, lo, hi), stored, of the items of large groups that ask.

    ``n`` similarities; ``lo`` and ``hi`` are those at the ranks ``a`` and
    ``b`` (from 0), which ``ranks`` gives for n; null where there are none.
    ``top`` is the greatest ``best``.
    """
    kinds = f"grp {kind_of(tiling.held, 'grp')}, item {kind_of(tiling.held, 'item')}"
    counted = each_tile(tiling.big(), _first_digit(best), f"{kinds}, counts array<bigint>, top double", strangers, floor)
    sums = counted.groupBy("grp", "item").agg(_summed("counts").alias("counts"), F.max("top").alias("top"))
    sums = sums.withColumn("n", F.aggregate("counts", F.lit(0).cast("bigint"), lambda t, c: t + c))
    a, b = ranks(F.col("n"))
    sums = sums.withColumns({"a": a.cast("bigint"), "b": b.cast("bigint")}).withColumns({"wa": _walk("counts", "a"), "wb": _walk("counts", "b")})
    moved = [(F.col("a") - F.col("wa.below")).alias("ra"), F.col("wa.digit").alias("pa"), (F.col("b") - F.col("wb.below")).alias("rb"), F.col("wb.digit").alias("pb")]
    state = scratch.save(sums.select("grp", "item", "n", "top", "a", "b", *moved), "first-digit")
    none = state.where("n = 0").select("grp", "item", "n", "top", F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("b"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    for round_no in range(1, ROUNDS):
        counted = each_tile(tiling.big(state.select("grp", "item", "pa", "pb")), _next_digit(round_no), f"{kinds}, ca array<bigint>, cb array<bigint>", strangers, floor)
        sums = counted.groupBy("grp", "item").agg(_summed("ca").alias("ca"), _summed("cb").alias("cb"))
        found = state.join(sums, ["grp", "item"]).withColumns({"wa": _walk("ca", "ra"), "wb": _walk("cb", "rb")})
        digits = 1 << BITS
        moved = [
            (F.col("ra") - F.col("wa.below")).alias("ra"), (F.col("pa") * digits + F.col("wa.digit")).alias("pa"), (F.col("rb") - F.col("wb.below")).alias("rb"), (F.col("pb") * digits + F.col("wb.digit")).alias("pb"),
        ]
        state = scratch.save(found.select("grp", "item", "n", "top", "a", "b", *moved), "next-digit")
    left = each_tile(tiling.big(state.select("grp", "item", "pa", "pb")), _values, f"{kinds}, place bigint, value double, times bigint", strangers, floor)
    left = left.groupBy("grp", "item", "place", "value").agg(F.sum("times").alias("times"))
    # A place holds one in four thousand of the range; a sum over its values in order finds the ranks.
    placed = left.withColumn("upto", F.sum("times").over(W.partitionBy("grp", "item", "place").orderBy("value"))).join(state, ["grp", "item"])
    at = lambda p, r: F.max(F.when((F.col("place") == F.col(p)) & (F.col("upto") > F.col(r)) & (F.col("upto") - F.col("times") <= F.col(r)), F.col("value")))
    some = placed.groupBy("grp", "item", "n", "top", "a", "b").agg(at("pa", "ra").alias("lo"), at("pb", "rb").alias("hi"))
    return scratch.save(some.unionByName(none), "ends")


def sums_between(tiling: Tiling, ends: DataFrame, strangers: bool = False, floor: float | None = None) -> DataFrame:
    """(grp, item, below, at_lo, inner, at_hi): counts below and at value ``lo``, the sum strictly between, the count at ``hi``; of ``ends`` (grp, item, lo, hi)."""
    keys = f"grp {kind_of(tiling.held, 'grp')}, item {kind_of(tiling.held, 'item')}"

    def run(tile: Tile) -> pa.Table | None:
        parts = []
        for rows, sim in tile.similarities():
            lo, hi = (tile.column(c, rows).to_numpy(zero_copy_only=False).astype(np.float64)[:, None] for c in ("lo", "hi"))
            with np.errstate(invalid="ignore"):
                inner = (sim > lo) & (sim < hi)
                parts.append(pa.table({
                    "grp": tile.column("grp", rows), "item": tile.column("item", rows),
                    "below": (sim < lo).sum(1), "at_lo": (sim == lo).sum(1), "inner": np.where(inner, sim, 0).sum(1), "between": inner.sum(1),
                }))
        return pa.concat_tables(parts) if parts else None

    found = each_tile(tiling.big(ends.select("grp", "item", "lo", "hi")), run, f"{keys}, below bigint, at_lo bigint, inner double, between bigint", strangers, floor)
    return found.groupBy("grp", "item").agg(*[F.sum(c).alias(c) for c in ("below", "at_lo", "inner", "between")])
