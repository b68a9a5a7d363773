"""How well each item of a group agrees with the others, and robust statistics of that.

Items are rows (grp, item, vec): one row per item of a group, its vector of unit
length (``functions.vectors.unit``), so inner products are cosines.  Null is the
missing value throughout; NaN never comes out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens.config import Consensus, Gate
from peerlens.functions.aggregates import smallest
from peerlens.operators.ranking import quantiles
from peerlens.operators.ranks import sums_between, values_at_ranks
from peerlens.operators.scratch import Scratch
from peerlens.operators.tiles import BLOCK, Tile, Tiling, best_in_tile, each_tile, kind_of, rank_range, sides, statistic


def consensus(items: DataFrame, others: DataFrame | None = None, how: Consensus | None = None, block: int = BLOCK) -> DataFrame:
    """(grp, item, n_peers, s): the peer statistic of each item over its group.

    ``others`` (grp, item, vec) are the peers where they come from another
    group, under the asking group's name; else an item never is its own peer.
    No peers give n_peers 0 and s null, fewer than ``min_peers_for_median``
    their mean.  Groups of more than ``block`` items are counted over tiles,
    with the same result.
    """
    rows = sides(items, others).withColumn("w", F.lit(None).cast("double"))
    return peer_statistic(rows, how or Consensus(), others is not None, None, block).drop("top")


def peer_statistic(rows: DataFrame, how: Consensus, strangers: bool, floor: float | None, block: int) -> DataFrame:
    """(grp, item, n_peers, s, top) of the rows that ask: over peers at ``floor`` or more, and the greatest ``w`` of those."""
    tiling = Tiling(rows, block)
    tiles = tiling.small()
    keys = f"grp {kind_of(tiles, 'grp')}, item {kind_of(tiles, 'item')}"

    def best(tile: Tile, sim: np.ndarray) -> pa.Array:
        w = tile.column("w", tile.g).to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.where(np.isnan(sim) | np.isnan(w), -np.inf, w).max(axis=1, initial=-np.inf)
        return pa.array(top, mask=np.isinf(top))

    def whole(tile: Tile) -> pa.Table | None:
        parts = []
        for rows, sim in tile.similarities():
            n, s = statistic(sim, how.method, how.trim_fraction, how.min_peers_for_median)
            parts.append(pa.table({"grp": tile.column("grp", rows), "item": tile.column("item", rows), "n_peers": n.astype(np.int32), "s": pa.array(s, mask=np.isnan(s)), "top": best(tile, sim)}))
        return pa.concat_tables(parts) if parts else None

    small = each_tile(tiles, whole, f"{keys}, n_peers int, s double, top double", strangers, floor)
    return small.unionByName(_over_tiles(tiling, how, best, strangers, floor)) if tiling.large else small


def _over_tiles(tiling: Tiling, how: Consensus, best, strangers: bool, floor: float | None) -> DataFrame:
    """The statistic of large groups, from the values at two ranks, and for a trimmed mean the sum between them."""
    rank_range(np.array([1]), how.method, how.trim_fraction, 0)  # says if there is no such statistic

    def ranks(n: Column) -> tuple[Column, Column]:
        if how.method == "median":
            lo, hi = F.floor((n - 1) / 2), F.floor(n / 2)
        else:
            lo = F.floor(n * how.trim_fraction)
            hi = n - lo - 1
        few = n < how.min_peers_for_median
        return F.when(few, F.lit(0)).otherwise(lo), F.when(few, n - 1).otherwise(hi)

    scratch = Scratch(tiling.held.sparkSession, "ranks")
    ends = values_at_ranks(tiling, ranks, best, scratch, strangers, floor)
    if how.method == "median" and how.min_peers_for_median <= 3:
        s = (F.col("lo") + F.col("hi")) / 2
    else:
        ends = ends.join(sums_between(tiling, ends, strangers, floor), ["grp", "item"])
        # Ranks a to b: those at lo from a on, those between, and the rest at hi.
        size = F.col("b") - F.col("a") + 1
        from_lo = F.least(F.col("below") + F.col("at_lo") - F.col("a"), size)
        s = F.when(F.col("n") > 0, (from_lo * F.col("lo") + F.col("inner") + (size - from_lo - F.col("between")) * F.col("hi")) / size)
    return ends.select("grp", "item", F.col("n").cast("int").alias("n_peers"), s.alias("s"), "top")


#: Scores of a group whose medians one aggregate takes; larger groups are ranked by ranges.
MEDIAN_ROWS = 1 << 16


def modified_z(scores: DataFrame, mad_floor: float = 0.01, scratch: Scratch | None = None, most: int = MEDIAN_ROWS) -> DataFrame:
    """``scores`` (grp, item, s, …) with n_scored, median_s, mad and z = 0.6745 (s - median) / max(MAD, floor).

    The scores are stored first, as several plans read them.  Groups of up to
    ``most`` scores have their medians from one aggregate; those of larger ones
    are taken by rank, so a group of any size is spread over tasks.  Null s is
    no value and has a null z.
    """
    scratch = scratch or Scratch(scores.sparkSession, "z")
    scores = scratch.save(scores, "consensus")
    size = scores.groupBy("grp").agg(F.count(F.lit(1)).cast("int").alias("n_scored"))
    large = None
    if scores.count() > most:
        large = scratch.save(size.where(F.col("n_scored") > most).select("grp"), "large")
        large = None if large.isEmpty() else large

    def medians(rows: DataFrame, value: str, name: str) -> DataFrame:
        if large is None:
            return rows.groupBy("grp").agg(F.median(value).alias(name))
        few = rows.join(large, "grp", "left_anti").groupBy("grp").agg(F.median(value).alias(name))
        many = quantiles(rows.join(large, "grp", "left_semi"), "grp", value, [0.5], scratch)
        return few.unionByName(many.select("grp", F.col("q")[0].alias(name)))

    with_median = scores.join(size, "grp", "left").join(medians(scores, "s", "median_s"), "grp", "left")
    away = with_median.select("grp", F.abs(F.col("s") - F.col("median_s")).alias("away"))
    z = 0.6745 * (F.col("s") - F.col("median_s")) / F.greatest("mad", F.lit(mad_floor))
    return with_median.join(medians(away, "away", "mad"), "grp", "left").withColumn("z", z)


def folders(scored: DataFrame, gate: Gate | None = None) -> DataFrame:
    """(grp, n_scored, median_s, mad, review) of each group; ``review`` where three or more items agree too little."""
    gate = gate or Gate()
    one = scored.groupBy("grp").agg(F.max("n_scored").alias("n_scored"), F.max("median_s").alias("median_s"), F.max("mad").alias("mad"))
    return one.withColumn("review", F.coalesce((F.col("n_scored") >= 3) & (F.col("median_s") < gate.folder_review_floor), F.lit(False)))


def dual_gate(z: Column, p: Column, z_thresh: float, p_thresh: float) -> Column:
    """Low z and high posterior both; false where either is missing."""
    return F.coalesce((z < -z_thresh) & (p >= p_thresh), F.lit(False))


def candidate(n: Column, z: Column, p: Column, gate: Gate) -> Column:
    """Whether an item is looked at closer: low z or high posterior; both of a pair; a single item never."""
    return F.when(n >= 3, F.coalesce(z < -gate.z_thresh, F.lit(False)) | F.coalesce(p >= gate.p_abs, F.lit(False))).otherwise(n == 2)


def top_peers(items: DataFrame, k: int, others: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """(grp, item, rank, peer, cos): the k most similar peers of each item; equal ones by name."""
    tiles = Tiling(sides(items, others), block).every()
    key, item = kind_of(tiles, "grp"), kind_of(tiles, "item")
    found = each_tile(tiles, best_in_tile(k), f"grp {key}, item {item}, peer {item}, cos double")
    heaps = found.groupBy("grp", "item").agg(smallest(F.struct((-F.col("cos")).alias("far"), "peer"), k).alias("h"))
    return heaps.select("grp", "item", F.posexplode("h").alias("pos", "e")).select(
        "grp", "item", (F.col("pos") + 1).alias("rank"), F.col("e.peer").alias("peer"), (-F.col("e.far")).alias("cos"),
    )


def typical_peers(scores: DataFrame, k: int) -> DataFrame:
    """(grp, rank, peer): the k + 1 items of greatest s in each group, so that k remain without the asking item; equal ones by name."""
    entry = F.struct((-F.col("s")).alias("low"), F.col("item").alias("peer"))
    heaps = scores.where("s is not null").groupBy("grp").agg(smallest(entry, k + 1).alias("h"))
    return heaps.select("grp", F.posexplode("h").alias("pos", "e")).select("grp", (F.col("pos") + 1).alias("rank"), F.col("e.peer").alias("peer"))


def peers_to_verify(asking: DataFrame, supported: DataFrame, scores: DataFrame, k_similar: int, k_typical: int) -> DataFrame:
    """(grp, item, pos, peer): the k most similar of the supported peers, then the k most typical of the group that aren't among them.

    Each list is cut before duplicates go, so an item may have fewer peers.
    """
    similar = top_peers(asking, k_similar, supported).select("grp", "item", F.col("rank").alias("pos"), "peer")
    typical = asking.select("grp", "item").join(typical_peers(scores, k_typical), "grp").where("item <> peer")
    # Without itself an item has its first k typical peers left.
    entry = smallest(F.struct("rank", "peer"), k_typical)
    typical = typical.groupBy("grp", "item").agg(entry.alias("h")).select("grp", "item", F.posexplode("h").alias("p", "e"))
    typical = typical.select("grp", "item", (F.col("p") + 1 + k_similar).alias("pos"), F.col("e.peer").alias("peer"))
    both = similar.unionByName(typical)
    return both.groupBy("grp", "item", "peer").agg(F.min("pos").alias("pos")).select("grp", "item", "pos", "peer")


def support_groups(asking: DataFrame, others: DataFrame, floor: float, min_size: int, block: int = BLOCK) -> DataFrame:
    """(grp, item, size, s_sub, anchored) of each asking item with enough peers at ``floor`` or more.

    The peers are a star around the item: they needn't be alike.  ``size``
    counts the item too; ``s_sub`` is the median similarity to those peers;
    ``anchored`` says whether any of them has ``s`` at the floor itself.
    ``others`` is (grp, item, vec, s).
    """
    rows = asking.select("grp", "item", "vec", F.lit(None).cast("double").alias("w"), F.lit(True).alias("l"), F.lit(False).alias("r")).unionByName(
        others.select("grp", "item", "vec", F.col("s").alias("w"), F.lit(False).alias("l"), F.lit(True).alias("r"))
    )
    found = peer_statistic(rows, Consensus(min_peers_for_median=1), False, floor, block)
    return found.where((F.col("n_peers") > 0) & (F.col("n_peers") + 1 >= min_size)).select(
        "grp", "item", (F.col("n_peers") + 1).alias("size"), F.col("s").alias("s_sub"), F.coalesce(F.col("top") >= floor, F.lit(False)).alias("anchored"),
    )


def similarity_profile(items: DataFrame, others: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """(grp, item, n_peers, least, mean, greatest): the similarities of each item to its peers in four mergeable numbers."""
    tiles = Tiling(sides(items, others), block).every()
    keys = f"grp {kind_of(tiles, 'grp')}, item {kind_of(tiles, 'item')}"

    def run(tile: Tile) -> pa.Table | None:
        parts = []
        for rows, sim in tile.similarities():
            there = ~np.isnan(sim)
            n = there.sum(1)
            parts.append(pa.table({
                "grp": tile.column("grp", rows), "item": tile.column("item", rows), "n": n, "total": np.where(there, sim, 0).sum(1),
                "least": pa.array(np.where(there, sim, np.inf).min(1, initial=np.inf), mask=n == 0), "greatest": pa.array(np.where(there, sim, -np.inf).max(1, initial=-np.inf), mask=n == 0),
            }))
        return pa.concat_tables(parts) if parts else None

    found = each_tile(tiles, run, f"{keys}, n bigint, total double, least double, greatest double", others is not None)
    total = F.sum("n")
    return found.groupBy("grp", "item").agg(
        total.cast("int").alias("n_peers"), F.min("least").alias("least"), F.when(total > 0, F.sum("total") / total).alias("mean"), F.max("greatest").alias("greatest"),
    )


def pair_quantiles(items: DataFrame, at: list[float], others: DataFrame | None = None, block: int = BLOCK) -> dict[float, float]:
    """Interpolated quantiles over the similarities of all pairs, each pair of one group once; exact, without a row per pair.

    One pass over the tiles counts the values per range; a second gathers the
    few values of the ranges that hold a wanted rank, as (value, count).
    """
    tiles = Tiling(sides(items, others), block).every()
    ranges = 1 << 14
    once = others is None

    def scale(sim: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            return np.minimum(np.floor((np.clip(sim, -1.000001, 1.000001) + 1.000001) / 2.000002 * ranges), ranges - 1)

    def halves(tile: Tile, rows: np.ndarray, sim: np.ndarray) -> np.ndarray:
        """Without the second of the two directions of a pair."""
        names = tile.table.column("item").to_numpy(zero_copy_only=False)
        return np.where(names[rows][:, None] < names[tile.g][None, :], sim, np.nan) if once else sim

    def count(tile: Tile) -> pa.Table | None:
        total = np.zeros(ranges, np.int64)
        for rows, sim in tile.similarities():
            place = scale(halves(tile, rows, sim))
            total += np.bincount(place[~np.isnan(place)].astype(np.int64), minlength=ranges)
        held = np.nonzero(total)[0]
        return pa.table({"place": held.astype(np.int32), "n": total[held]})

    counts = each_tile(tiles, count, "place int, n bigint", not once).groupBy("place").agg(F.sum("n").alias("n")).orderBy("place").collect()
    n = sum(r["n"] for r in counts)
    if not n:
        return {q: float("nan") for q in at}
    ranks = sorted({r for q in at for r in (int(np.floor(q * (n - 1))), int(np.ceil(q * (n - 1))))})
    before, need = {}, set()
    seen, left = 0, list(ranks)
    for r in counts:
        while left and left[0] < seen + r["n"]:
            need.add(r["place"])
            before.setdefault(r["place"], seen)
            left.pop(0)
        seen += r["n"]

    def values(tile: Tile) -> pa.Table | None:
        parts = []
        for rows, sim in tile.similarities():
            sim = halves(tile, rows, sim)
            place = scale(sim)
            v, times = np.unique(sim[np.isin(place, list(need))], return_counts=True)
            parts.append(pa.table({"place": scale(v).astype(np.int32), "value": v, "n": times}))
        return pa.concat_tables(parts) if parts else None

    # A range holds about one in ten thousand of the pairs; a sum over ranks inside it happens in Spark.
    from pyspark.sql import Window as W

    held = each_tile(tiles, values, "place int, value double, n bigint", not once).groupBy("place", "value").agg(F.sum("n").alias("n"))
    starts = F.create_map(*[F.lit(x) for p in before.items() for x in p])
    upto = F.sum("n").over(W.partitionBy("place").orderBy("value")) + starts[F.col("place")]
    wanted = F.array(*[F.lit(r) for r in ranks])
    hit = held.withColumn("upto", upto).withColumn("r", F.explode(F.filter(wanted, lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))))
    value = {r["r"]: r["value"] for r in hit.select("r", "value").collect()}
    out = {}
    for q in at:
        lo, hi = int(np.floor(q * (n - 1))), int(np.ceil(q * (n - 1)))
        out[q] = value[lo] + (value[hi] - value[lo]) * (q * (n - 1) - lo)
    return out
