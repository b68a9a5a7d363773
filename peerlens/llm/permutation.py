"""Most similar vectors for every vector, by a permutation index.

Every vector is represented by its nearest pivots in their order and posted in
the inverted file of each of them.  Two vectors that share a list are compared
by the footrule distance of their pivot orders (a pivot that one of them lacks
counts as just beyond its last); the best of that ranking are reranked by exact
cosine, and the neighbours found in a vector's lists merge in one bounded heap.

Pivots are vectors of the collection drawn by a hash of their ids, so where the
collection is dense there are more of them, and their number follows the number
of vectors; lists stay short.  Many pivots are in cells of two levels, and a
vector looks at those in its nearest cells, so what it is compared with grows
with the root of their number.  A list that is long all the same is split: its
vectors get blocks, and each pair of blocks is a list of its own, with the one
as queries and the other as targets, which loses nothing.

Exact copies are one vector in the index, so copies never fill a list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens.functions.aggregates import smallest
from peerlens.operators.scratch import Scratch
from peerlens.operators.skew import join_to_one

#: Nearest pivots kept of each vector, in order, and how many of them it is posted under: all, as neighbours are lost with each that is left out.
PREFIX, POSTS = 6, 6
#: One pivot for so many vectors, between the two bounds; the upper one bounds what is broadcast (64 MB at 64 dimensions).
PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS = 64, 64, 1 << 18
#: Up to so many pivots are all compared; more are looked for in so many of the nearest cells.
FLAT, CELLS = 4096, 16
#: Of each list, so many go from the footrule ranking to the exact rerank (and all that tie with the last).
RERANK = 128
#: Vectors in a list before it is split.
LIST = 2048


def usable(vec: Column, dim: int) -> Column:
    """True where the vector has ``dim`` finite values that aren't all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) == dim) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first so that no square overflows or vanishes."""
    v = v.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


class Pivots:
    """Pivots of length one in cells, each cell the pivots that are nearest to one of its centres.

    Centres are the first pivots, which are drawn at random, as many as make
    the cells about as large as their number is; where pivots are few there is
    one cell.
    """

    def __init__(self, vectors: np.ndarray, flat: int = FLAT):
        self.vectors = vectors
        n = len(vectors)
        self.centres = vectors[: 1 if n <= flat else int(np.ceil(np.sqrt(n)) * 2)]
        cell = np.concatenate([(vectors[i : i + 8192] @ self.centres.T).argmax(1) for i in range(0, n, 8192)])
        self.order = np.argsort(cell, kind="stable")
        self.begin = np.searchsorted(cell[self.order], np.arange(len(self.centres) + 1))

    def nearest(self, v: np.ndarray, prefix: int, cells: int = CELLS) -> np.ndarray:
        """The ``prefix`` pivots of greatest cosine of each row, in order, equal ones by their number; of the pivots in the cells nearest to it."""
        v = v.astype(np.float32)
        if len(self.centres) <= cells:
            return _best(v, self.vectors, prefix)
        sim = v @ self.centres.T
        near = np.argpartition(-sim, cells - 1, axis=1)[:, :cells]
        where = np.argsort(near, axis=None, kind="stable")
        rows, which = where // cells, near.ravel()[where]
        cuts = np.searchsorted(which, np.arange(len(self.centres) + 1))
        owner, pivot, cos = [], [], []
        for c in np.unique(which):
            mine, held = rows[cuts[c] : cuts[c + 1]], self.order[self.begin[c] : self.begin[c + 1]]
            if not len(held):
                continue
            some = min(prefix, len(held))
            at = _best(v[mine], self.vectors[held], some)
            owner.append(np.repeat(mine, some))
            pivot.append(held[at].ravel())
            cos.append(np.einsum("ij,ikj->ik", v[mine], self.vectors[held][at]).ravel())
        owner, pivot, cos = np.concatenate(owner), np.concatenate(pivot), np.concatenate(cos)
        best = np.lexsort((pivot, -cos, owner))
        owner, pivot = owner[best], pivot[best]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        out = np.full((len(v), prefix), -1, np.int32)
        out[owner[place < prefix], place[place < prefix]] = pivot[place < prefix]
        # Rows whose cells hold too few pivots look at all.
        if (few := (out < 0).any(1)).any():
            out[few] = _best(v[few], self.vectors, prefix)
        return out


def _best(v: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` of all ``pivots`` of greatest cosine of each row, in order; equal ones by their number."""
    out = np.empty((len(v), prefix), np.int32)
    step = max(1, 2**23 // max(1, len(pivots)))
    for at in range(0, len(v), step):
        sim = v[at : at + step] @ pivots.T
        if prefix < len(pivots):
            best = np.argpartition(-sim, prefix - 1, axis=1)[:, :prefix]
        else:
            best = np.broadcast_to(np.arange(len(pivots)), sim.shape)
        near = np.take_along_axis(sim, best, 1)
        out[at : at + step] = np.take_along_axis(best, np.lexsort((best, -near), axis=1), 1)
    return out


def footrule_closeness(order: np.ndarray) -> np.ndarray:
    """Closeness of each two rows of pivot orders; the footrule distance is ``m * (m + 1)`` less twice this.

    With weight m - position, and 0 for a pivot that a row lacks, the distance
    is the sum of weights less twice the sum of the smaller weights, and the
    sum of smaller weights is a product of 0/1 matrices, one for each weight.
    """
    n, m = order.shape
    pivots, at = np.unique(order, return_inverse=True)
    weight = np.zeros((n, len(pivots)), np.int8)
    weight[np.arange(n)[:, None], at.reshape(n, m)] = m - np.arange(m, dtype=np.int8)
    close = np.zeros((n, n), np.float32)
    for t in range(1, m + 1):
        bits = (weight >= t).astype(np.float32)
        close += bits @ bits.T
    return close


def _posted(pivots_b, prefix: int, posts: int, width: str, flat: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = Pivots(pivots_b.value, flat)
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.stack(batch.column("vec").to_numpy(zero_copy_only=False)).astype(np.float32)
            order = pivots.nearest(_unit(raw), prefix)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("ids"), batch.column("copies"), pa.array([r.tobytes() for r in raw], pa.binary()), pa.array(list(order[:, :posts]), pa.list_(pa.int32())), pa.array([r.tobytes() for r in order.astype(width)], pa.binary())],
                names=["rep", "ids", "copies", "raw", "pivots", "ordered"],
            )

    return run


def _searched(k: int, least: float, rerank: int, width: str) -> Callable[[pa.Table], pa.Table]:
    """The k best of its list for each query of the list, from ``least`` cosine on."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("rep")
        n = table.num_rows
        order = np.frombuffer(b"".join(table.column("ordered").to_pylist()), width).reshape(n, -1)
        v = _unit(np.frombuffer(b"".join(table.column("raw").to_pylist()), np.float32).reshape(n, -1))
        query, target = table.column("query").to_numpy(), table.column("target").to_numpy()
        sim = v.astype(np.float32) @ v.astype(np.float32).T
        close = footrule_closeness(order)
        dead = np.broadcast_to(~target, (n, n)).copy()
        np.fill_diagonal(dead, True)
        close[dead] = -1
        if n > rerank:
            floor = np.partition(close, n - rerank, axis=1)[:, n - rerank]
            dead |= close < floor[:, None]
        sim[dead | (sim < least - 1e-4)] = -2
        sim[~query] = -2
        # All whose float32 cosine can't be told from the k-th best go on to double precision.
        few = min(n, k)
        kth = np.partition(sim, n - few, axis=1)[:, n - few]
        q, t = np.nonzero((sim > -2) & (sim >= kth[:, None] - 1e-6))
        # By parts, as where very many are alike all pairs of the list may be here.
        cos = np.concatenate([np.einsum("ij,ij->i", v[q[i : i + 2**17]], v[t[i : i + 2**17]]) for i in range(0, max(1, len(q)), 2**17)])
        keep = cos >= least
        q, t, cos = q[keep], t[keep], cos[keep]
        # The k best of them, equal ones by the smaller item as in the merge; rows are sorted by it.
        order = np.lexsort((t, -np.round(cos, 12), q))
        q, t, cos = q[order], t[order], cos[order]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < k
        q, t, cos = q[keep], t[keep], cos[keep]
        return pa.table({
            "rep": table.column("rep").take(pa.array(q)),
            "cos": pa.array(cos, pa.float64()), "other": table.column("rep").take(pa.array(t)), "other_ids": table.column("ids").take(pa.array(t)),
        })

    return run


def nearest_vectors(
    df: DataFrame, item: str, vec: str, dim: int, k: int, least: float = -1.0,
    *, prefix: int = PREFIX, posts: int = POSTS, per_pivot: int = PER_PIVOT, rerank: int = RERANK, longest: int = LIST, flat: int = FLAT,
) -> DataFrame:
    """(item, other, cos): the ``k`` items of greatest cosine to each item, of those with cosine ``least`` or more.

    Rows whose item is null or whose vector isn't usable are left out.  Of rows
    with one item the least vector counts.  Equal cosines go by the smaller
    item; exact copies have cosine 1.  An empty table gives an empty result.
    The search is approximate: a neighbour is missed where it shares no near
    pivot or is beyond the rerank in all lists.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = df.where(F.col(item).isNotNull() & usable(F.col(vec), dim)).select(F.col(item).cast("long").alias("item"), F.col(vec).cast("array<float>").alias("vec"))
    rows = scratch.save(rows.groupBy("item").agg(F.min("vec").alias("vec")), "rows")
    # One row per distinct vector, with its k + 1 smallest items: no item needs more of its copies than that.
    reps = rows.groupBy("vec").agg(smallest(F.col("item"), k + 1).alias("ids"), F.count(F.lit(1)).alias("copies"))
    reps = scratch.save(reps.select(F.col("ids")[0].alias("rep"), "ids", "copies", "vec"), "reps")
    several = scratch.save(reps.where("copies > 1"), "several")
    n = reps.count()
    if n == 0:
        return spark.createDataFrame([], "item long, other long, cos double")
    wanted = min(n, max(LEAST_PIVOTS, min(MOST_PIVOTS, n // per_pivot)))
    drawn = reps.select("rep", "vec").orderBy(F.xxhash64("rep", F.lit(11)), "rep").limit(wanted).toArrow()
    pivots = _unit(np.stack(drawn.column("vec").combine_chunks().to_numpy(zero_copy_only=False))).astype(np.float32)
    prefix = min(prefix, len(pivots))
    posts = min(posts, prefix)
    pivots_b = spark.sparkContext.broadcast(pivots)
    width = "int16" if len(pivots) < 1 << 15 else "int32"
    posted = reps.select("rep", "ids", "vec", "copies").mapInArrow(_posted(pivots_b, prefix, posts, width, flat), "rep long, ids array<long>, copies long, raw binary, pivots array<int>, ordered binary")
    posted = scratch.save(posted, "posted")
    scratch.drop(reps)
    # There are no more lists than pivots, so the long ones are a table of bounded size.
    sizes = posted.select(F.explode("pivots").alias("pivot")).groupBy("pivot").count()
    long_lists = sizes.where(F.col("count") > longest).select("pivot", F.ceil(F.col("count") / longest).cast("int").alias("parts"))
    # A vector without copies needs no list of items beside its name.
    shared = F.when(F.col("copies") > 1, F.col("ids"))
    lists = posted.select("rep", shared.alias("ids"), "raw", "ordered", F.explode("pivots").alias("pivot"))
    lists = lists.join(F.broadcast(long_lists), "pivot", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    lists = lists.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    # Cell (i, j) of a list holds the queries of block i and the targets of block j.
    cells = F.expr("flatten(transform(sequence(0, parts - 1), i -> array(struct(mine AS qi, i AS tj), struct(i AS qi, mine AS tj))))")
    lists = lists.select("rep", "ids", "raw", "ordered", "pivot", "mine", F.explode(F.array_distinct(cells)).alias("cell"))
    lists = lists.select(
        "rep", "ids", "raw", "ordered", "pivot", F.col("cell.qi").alias("qi"), F.col("cell.tj").alias("tj"),
        (F.col("cell.qi") == F.col("mine")).alias("query"), (F.col("cell.tj") == F.col("mine")).alias("target"),
    )
    found = lists.groupBy("pivot", "qi", "tj").applyInArrow(_searched(k, least, rerank, width), "rep long, cos double, other long, other_ids array<long>")
    # Stored, so the postings' shuffle files are gone before the neighbours meet.
    found = scratch.save(found, "found")
    # A neighbour comes from at most ``posts`` lists, so k * posts entries hold k different ones.
    entry = F.struct((-F.round("cos", 12)).alias("far"), F.col("other"), F.coalesce("other_ids", F.array("other")).alias("ids"))
    merged = found.groupBy("rep").agg(smallest(entry, k * posts).alias("heap"))
    outside = merged.select("rep", F.slice(F.array_sort(F.array_distinct("heap")), 1, k).alias("heap"))
    outside = outside.select("rep", F.expr("flatten(transform(heap, e -> transform(e.ids, i -> struct(e.far AS far, i AS other))))").alias("outside"))
    # Copies come before all others; a class of more than k needs nobody else.
    every = posted.where("copies = 1").select(F.col("rep").alias("item"), "rep", F.array().cast("array<long>").alias("ids"))
    if not several.isEmpty():
        every = every.unionByName(join_to_one(rows, several, ["vec"], scratch).select("item", "rep", "ids"))
    every = every.join(outside, "rep", "left")
    own = F.transform(F.filter("ids", lambda i: i != F.col("item")), lambda i: F.struct(F.lit(-1.0).alias("far"), i.alias("other")))
    best = F.slice(F.array_sort(F.concat(own, F.coalesce("outside", F.array().cast("array<struct<far:double,other:bigint>>")))), 1, k)
    return every.select("item", F.explode(best).alias("e")).select("item", F.col("e.other").alias("other"), (-F.col("e.far")).alias("cos"))


def similar_photos(vectors: DataFrame, k: int = 5, least: float = 0.90, dim: int = 64, model: str = "dinov2") -> DataFrame:
    """(vec_id_a, vec_id_b), a < b: pairs of which either vector is among the ``k`` most similar of the other."""
    found = nearest_vectors(vectors.where(F.col("model") == model), "vec_id", "vec", dim, k, least)
    return found.select(F.least("item", "other").alias("vec_id_a"), F.greatest("item", "other").alias("vec_id_b")).distinct()
