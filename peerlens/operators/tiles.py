"""Similarity inside groups, tile by tile, without a row per pair.

The items of a group are cut into blocks of bounded size, and each pair of
blocks is a tile: a matrix product in one task that returns only what the
operator asks for (the best few per item, a statistic, counts).  A group of any
size is thus spread over many tasks, none of which holds more than two blocks.
Groups of one block, which are most, are packed many to a task.

Statistics that don't merge, like the median, are exact for groups of more than
one block too: the rank wanted is narrowed down by counts per value range over
all tiles until the few values left can be sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.operators.scratch import Scratch

#: Items in a block, and items packed into one task from small groups.
BLOCK, PACK = 8192, 8192


def sides(left: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """Rows (grp, item, vec, l, r): what is asked about (l) and what it is compared with (r); one table is both."""
    if right is None:
        return left.select("grp", "item", "vec", F.lit(True).alias("l"), F.lit(True).alias("r"))
    return left.select("grp", "item", "vec", F.lit(True).alias("l"), F.lit(False).alias("r")).unionByName(
        right.select("grp", "item", "vec", F.lit(False).alias("l"), F.lit(True).alias("r"))
    )


class Tiling:
    """Rows (grp, item, vec, l, r, and any others) cut into tiles: columns pack, bi, bj, ask and give.

    Groups of one block are packed many to a tile.  A row of a larger group
    stands in a tile once for each block it meets, so a pass over a group of n
    items copies n * n / block rows; the rows of such groups are stored once,
    and what a pass needs besides is joined before they are copied.  Rows with
    a null group, item or vector are left out.
    """

    def __init__(self, rows: DataFrame, block: int = 0, pack: int = PACK):
        block = block or BLOCK
        self.rows = rows.where("grp is not null and item is not null and vec is not null")
        sizes = self.rows.groupBy("grp").agg(F.count_if("l").alias("nl"), F.count_if("r").alias("nr"), F.count(F.lit(1)).alias("n"))
        most = sizes.agg(F.sum("n").alias("n"), F.max("nl").alias("nl"), F.max("nr").alias("nr")).first()
        self.packs = max(1, -(-(most["n"] or 0) // pack))
        self.large = max(most["nl"] or 0, most["nr"] or 0) > block
        self.held = None
        if self.large:
            scratch = Scratch(rows.sparkSession, "tiles")
            blocks = [F.greatest(F.ceil(F.col(n) / block), F.lit(1)).cast("int").alias(b) for n, b in (("nl", "bl"), ("nr", "br"))]
            which = scratch.save(sizes.where((F.col("nl") > block) | (F.col("nr") > block)).select("grp", *blocks), "large")
            self.held = scratch.save(self.rows.join(which, "grp"), "held")
            self.rows = self.rows.join(which.select("grp"), "grp", "left_anti")

    def small(self) -> DataFrame:
        return self.rows.select("*", F.pmod(F.xxhash64("grp"), F.lit(self.packs)).alias("pack"), F.lit(0).alias("bi"), F.lit(0).alias("bj"), F.col("l").alias("ask"), F.col("r").alias("give"))

    def big(self, state: DataFrame | None = None) -> DataFrame:
        """The tiles of the large groups, with the columns that ``state`` has for (grp, item)."""
        rows = self.held if state is None else self.held.join(state, ["grp", "item"], "left")
        keep = [c for c in rows.columns if c not in ("bl", "br")]
        placed = rows.withColumns({"mi": F.pmod(F.xxhash64("item"), F.col("bl")).cast("int"), "mj": F.pmod(F.xxhash64("item"), F.col("br")).cast("int")})
        asks = F.when(F.col("l"), F.expr("transform(sequence(0, br - 1), j -> struct(mi AS bi, j AS bj))"))
        gives = F.when(F.col("r"), F.expr("transform(sequence(0, bl - 1), i -> struct(i AS bi, mj AS bj))"))
        none = F.array().cast("array<struct<bi:int,bj:int>>")
        placed = placed.withColumn("t", F.explode(F.array_distinct(F.concat(F.coalesce(asks, none), F.coalesce(gives, none)))))
        # Two large groups on one number are told apart in the task.
        return placed.select(
            *keep, (-F.lit(1) - F.pmod(F.xxhash64("grp"), F.lit(1 << 40))).alias("pack"), F.col("t.bi").alias("bi"), F.col("t.bj").alias("bj"),
            (F.col("l") & (F.col("t.bi") == F.col("mi"))).alias("ask"), (F.col("r") & (F.col("t.bj") == F.col("mj"))).alias("give"),
        )

    def every(self) -> DataFrame:
        """All tiles, of groups of any size."""
        return self.small().unionByName(self.big()) if self.large else self.small()


class Tile:
    """One group's part in a task: who asks, who gives, and their similarities (NaN for an item with itself).

    Where peers come from another group, ``strangers``, equal names are
    different items.  Similarities below ``floor`` are NaN too.
    """

    def __init__(self, table: pa.Table, strangers: bool = False, floor: float | None = None):
        self.table, self.floor = table, floor
        names = table.column("item").to_numpy(zero_copy_only=False)
        self.code = np.arange(len(names)) if strangers else np.unique(names, return_inverse=True)[1]
        ask, give = table.column("ask").to_numpy(), table.column("give").to_numpy()
        self.a, self.g = np.nonzero(ask)[0], np.nonzero(give)[0]
        flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.v = flat.reshape(table.num_rows, -1) if table.num_rows else np.empty((0, 0))

    def __len__(self) -> int:
        return len(self.a)

    def similarities(self, step: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of the table that ask, their similarities to all that give), some rows at a time."""
        for at in range(0, len(self.a), step):
            rows = self.a[at : at + step]
            sim = self.v[rows] @ self.v[self.g].T
            sim[self.code[rows][:, None] == self.code[self.g][None, :]] = np.nan
            if self.floor is not None:
                sim[sim < self.floor] = np.nan
            yield rows, sim

    def column(self, name: str, rows: np.ndarray) -> pa.Array:
        return self.table.column(name).combine_chunks().take(pa.array(rows))


def each_tile(tiles: DataFrame, f: Callable[[Tile], pa.Table | None], schema: str, strangers: bool = False, floor: float | None = None) -> DataFrame:
    """Run ``f`` on every group's part of every tile and gather its tables."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("grp", "ascending"), ("item", "ascending")])
        groups = table.column("grp").to_pylist()
        cuts = [0, *[i for i in range(1, len(groups)) if groups[i] != groups[i - 1]], len(groups)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            if b > a and (found := f(Tile(table.slice(a, b - a), strangers, floor))) is not None and found.num_rows:
                out.append(found.select(arrow.names).cast(arrow))
        return pa.concat_tables(out) if out else arrow.empty_table()

    return tiles.groupBy("pack", "bi", "bj").applyInArrow(run, schema)


def kind_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def best_in_tile(k: int) -> Callable[[Tile], pa.Table | None]:
    """The k most similar of each asking item in a tile; ties by item."""

    def run(tile: Tile) -> pa.Table | None:
        parts = []
        for rows, sim in tile.similarities():
            sim = np.where(np.isnan(sim), -np.inf, sim)
            n = min(k, sim.shape[1])
            if not n:
                continue
            # Rows are sorted by item, so a stable sort leaves ties in their order.
            best = np.argsort(-sim, axis=1, kind="stable")[:, :n]
            q, c = np.nonzero(np.isfinite(np.take_along_axis(sim, best, 1)))
            t = best[q, c]
            parts.append(pa.table({"grp": tile.column("grp", rows[q]), "item": tile.column("item", rows[q]), "peer": tile.column("item", tile.g[t]), "cos": pa.array(sim[q, t])}))
        return pa.concat_tables(parts) if parts else None

    return run


def statistic(sims: np.ndarray, method: str, trim: float, min_peers: int) -> tuple[np.ndarray, np.ndarray]:
    """(count, statistic) of each row's values that aren't NaN: mean below ``min_peers``, else median or trimmed mean; NaN without values."""
    ordered = np.sort(sims, axis=1)  # NaN last
    n = np.sum(~np.isnan(ordered), axis=1)
    lo, hi = rank_range(n, method, trim, min_peers)
    width = max(ordered.shape[1], 1)
    at = np.arange(width)
    inside = (at >= lo[:, None]) & (at < hi[:, None]) if ordered.shape[1] else np.zeros((len(n), 0), bool)
    total = np.where(inside, ordered, 0).sum(1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return n, np.where(n > 0, total / (hi - lo), np.nan)


def rank_range(n: np.ndarray, method: str, trim: float, min_peers: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranks [lo, hi) whose mean is the statistic of n values in order."""
    if method not in ("median", "trimmed_mean"):
        raise ValueError(f"no such statistic: {method}")
    if method == "median":
        lo, hi = (n - 1) // 2, n // 2 + 1
    else:
        cut = np.floor(trim * n).astype(np.int64)
        lo, hi = cut, n - cut
    few = n < min_peers
    return np.where(few, 0, np.maximum(lo, 0)), np.where(few, n, hi)
