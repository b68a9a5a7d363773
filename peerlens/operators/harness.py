"""Evaluation by transplants: items of one group planted in another are the known outliers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens.config import Config
from peerlens.functions.aggregates import smallest
from peerlens.operators import decide
from peerlens.operators.calibrate import Ratio, donors, hashed_order
from peerlens.operators.consensus import top_peers
from peerlens.operators.ranking import ranked, running_totals
from peerlens.operators.scratch import Scratch

#: The thresholds of the table, steps of .02 up to .18 and of .05 from .20 to .95.
THRESHOLDS = tuple(round(0.02 * i, 2) for i in range(1, 10)) + tuple(round(0.20 + 0.05 * i, 2) for i in range(16))
PLANTED = "__inj__"


def targets(groups: DataFrame, fraction: float, seed: int) -> DataFrame:
    """(grp) of the groups that receive transplants: the first of the hash order, a rounded fraction and at least one."""
    n = groups.count()
    wanted = max(1, round(fraction * n))
    placed = ranked(groups.select("grp", F.lit("all").alias("one")), "one", [hashed_order(seed, "target", "grp").asc(), F.col("grp").asc()])
    return placed.where(F.col("rank") <= wanted).select("grp")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, n, total): how many vectors each group has in a batch, and their sum."""
    for batch in batches:
        if not batch.num_rows:
            continue
        named = batch.column("grp").dictionary_encode()
        code = named.indices.fill_null(len(named.dictionary)).to_numpy()
        flat = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        order = np.argsort(code, kind="stable")
        begin = np.flatnonzero(np.diff(code[order], prepend=-1))
        total = np.add.reduceat(flat[order], begin, axis=0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("grp").take(pa.array(order[begin])), pa.array(np.diff(np.append(begin, batch.num_rows))), pa.array(list(total), pa.list_(pa.float64()))], names=["grp", "n", "total"],
        )


def nearest_groups(reps: DataFrame, asking: DataFrame) -> DataFrame:
    """(grp, donor): the other group whose mean vector is most like that of each asking group; equal ones by name."""
    # Each batch of rows becomes one sum per group of it, so a group's items aren't exploded one by one.
    kind = reps.schema["grp"].dataType.simpleString()
    sums = reps.where("vec is not null").select("grp", F.col("vec").cast("array<double>").alias("vec")).mapInArrow(_summed, f"grp {kind}, n bigint, total array<double>")
    parts = sums.select("grp", "n", F.posexplode("total").alias("i", "x")).groupBy("grp", "i").agg((F.sum("x") / F.sum("n")).alias("x"))
    mean = parts.groupBy("grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("vec"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x * x))
    mean = mean.withColumn("norm", norm).where("norm > 0").select(F.lit("all").alias("grp"), F.col("grp").alias("item"), F.expr("transform(vec, x -> x / norm)").alias("vec"))
    wanted = mean.join(asking.select(F.col("grp").alias("item")), "item", "left_semi").select("grp", "item", "vec")
    return top_peers(wanted, 1, mean).select(F.col("item").alias("grp"), F.col("peer").alias("donor"))


def planted(items: DataFrame, reps: DataFrame, pairs: DataFrame, k: int, seed: int) -> DataFrame:
    """Rows like ``items`` (grp, item, sha, readable, bits): up to k representatives of each target's donor whose content the target lacks, renamed.

    ``pairs`` is (grp, donor).  Several targets may share a donor.
    """
    pool = pairs.join(reps.select(F.col("grp").alias("donor"), "item", "sha"), "donor").join(items.select("grp", "sha").distinct(), ["grp", "sha"], "left_anti")
    drawn = pool.withColumn("at", hashed_order(seed, "plant", "grp", "donor", "item"))
    heap = drawn.groupBy("grp", "donor").agg(smallest(F.struct("at", "item"), k).alias("h"))
    chosen = heap.select("grp", "donor", F.explode("h").alias("e")).select("grp", "donor", F.col("e.item").alias("item"))
    rows = chosen.join(items.withColumnRenamed("grp", "donor"), ["donor", "item"])
    return rows.select("grp", F.concat(F.lit(PLANTED), "donor", F.lit("__"), "item").alias("item"), "sha", "readable", "bits")


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    b = beta * beta
    below = b * precision + recall
    return F.when(below > 0, (1 + b) * precision * recall / below).otherwise(0.0)


def pr_table(rows: DataFrame, keys: Sequence[str], thresholds: Sequence[float] = THRESHOLDS, beta: float = 0.5) -> DataFrame:
    """(keys, threshold, n_flagged, tp, n_pos, precision, recall, f1, f_beta) from (keys, score, label, candidate).

    An item is flagged where it is a candidate with the score or more; recall
    is over all positives.  Empty denominators give 0.  One aggregation serves
    all thresholds: counts per number of thresholds reached, then sums.
    """
    if not keys:
        return pr_table(rows.withColumn("__all", F.lit(0)), ["__all"], thresholds, beta).drop("__all")
    at = F.array(*[F.lit(float(t)) for t in sorted(thresholds)])
    reached = F.when(F.col("candidate"), F.size(F.filter(at, lambda t: F.coalesce(F.col("score") >= t, F.lit(False))))).otherwise(0)
    label = F.col("label").cast("int")
    counts = rows.groupBy(*keys, reached.alias("reached")).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    total = counts.groupBy(*keys).agg(F.sum("pos").alias("n_pos"))
    spread = counts.select(*keys, "reached", "n", "pos", F.posexplode(at).alias("i", "threshold"))
    above = F.col("reached") > F.col("i")
    table = spread.groupBy(*keys, "threshold").agg(F.sum(F.when(above, F.col("n")).otherwise(0)).alias("n_flagged"), F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"))
    table = table.join(total, list(keys))
    precision = F.when(F.col("n_flagged") > 0, F.col("tp") / F.col("n_flagged")).otherwise(0.0)
    recall = F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).otherwise(0.0)
    table = table.withColumns({"precision": precision, "recall": recall})
    return table.withColumns({"f1": f_beta(F.col("precision"), F.col("recall"), 1.0), "f_beta": f_beta(F.col("precision"), F.col("recall"), beta)})


def average_precision(rows: DataFrame, keys: Sequence[str], scratch: Scratch | None = None) -> DataFrame:
    """(keys, ap) from (keys, score, label): the sum over distinct scores, descending, of recall gained times precision; 0 without positives."""
    label = F.col("label").cast("int")
    steps = rows.where("score is not null").groupBy(*keys, "score").agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    steps = running_totals(steps, keys, [F.col("score").desc()], {"seen": F.col("n"), "found": F.col("pos")}, scratch)
    gained = F.sum(F.col("pos") * F.col("found") / F.col("seen"))
    return steps.groupBy(*keys).agg(F.coalesce(F.when(F.sum("pos") > 0, gained / F.sum("pos")), F.lit(0.0)).alias("ap"))


def best_threshold(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest (f_beta, precision); the lowest threshold among equals."""
    best = F.max(F.struct("f_beta", "precision", (-F.col("threshold")).alias("low"), "recall", "n_flagged"))
    return table.groupBy(*keys).agg(best.alias("b")).select(*keys, (-F.col("b.low")).alias("threshold"), F.col("b.f_beta").alias("f_beta"), F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"), F.col("b.n_flagged").alias("n_flagged"))


def run(items: DataFrame, vectors: DataFrame, ready: decide.Prepared, ratio: Ratio, cfg: Config, scratch: Scratch, features: DataFrame | None = None) -> DataFrame:
    """(z, seed, mode, grp, item, score, label, candidate) of every scored item of every run.

    Seeds and modes are parts of the group name, so all runs are one plan;
    copies, vectors and consensus don't depend on z and are computed once, and
    the calibration isn't fitted again.  With the ``features`` of the audit
    that gave ``ready``, candidates are verified by geometry as they are there.
    """
    import dataclasses

    how = cfg.harness
    groups = ready.scores.where("n_scored >= 2").select("grp").distinct()
    worlds = None
    for seed in how.seeds:
        chosen = scratch.save(targets(groups, how.inject_fraction, seed), "targets")
        for mode in how.modes:
            pairs = nearest_groups(ready.reps, chosen) if mode == "hard" else donors(groups, seed, "easy").join(chosen, "grp", "left_semi")
            added = planted(ready.items, ready.reps, pairs, how.injections_per_folder, seed)
            world = ready.items.unionByName(added).withColumn("grp", F.concat_ws("/", F.lit(str(seed)), F.lit(mode), "grp"))
            worlds = world if worlds is None else worlds.unionByName(world)
    again = decide.prepare(worlds, vectors, cfg, scratch)
    at = lambda z: dataclasses.replace(cfg, gate=dataclasses.replace(cfg.gate, z_thresh=z))
    seen = None
    if features is not None and ready.geom is not None:
        # The least z has the candidates of all others, so nothing is matched twice.
        seen = scratch.save(decide.seen_by_candidates(again.reps, again.scores, ratio, features, at(min(how.z_grid))), "inliers")
    out = None
    for z in how.z_grid:
        gated = decide.gate(again.reps, again.scores, ratio, at(z), scratch, seen, ready.geom)
        part = F.split("grp", "/", 3)
        rows = gated.select(
            F.lit(z).alias("z"), part[0].cast("int").alias("seed"), part[1].alias("mode"), part[2].alias("grp"), "item",
            F.col("p").alias("score"), F.col("item").startswith(PLANTED).alias("label"), "candidate",
        )
        out = rows if out is None else out.unionByName(rows)
    return scratch.save(out, "runs")


def pooled(rows: DataFrame) -> DataFrame:
    """The rows under their mode and once more under ``all``."""
    return rows.select("*", F.explode(F.array("mode", F.lit("all"))).alias("pool"))


def operating_point(best: DataFrame, select_mode: str) -> DataFrame:
    """Across z of one mode: the row with the greatest (f_beta, precision), the least z among equals."""
    pick = F.max(F.struct("f_beta", "precision", (-F.col("z")).alias("low"), "threshold", "recall"))
    one = best.where(F.col("pool") == select_mode).agg(pick.alias("b"))
    return one.select((-F.col("b.low")).alias("z"), F.col("b.threshold").alias("threshold"), F.col("b.f_beta").alias("f_beta"), F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"))
