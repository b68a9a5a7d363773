"""The numbers that a run and an evaluation hand over: what was calibrated, flagged and measured."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.config import Config
from peerlens.operators import calibrate, consensus, harness
from peerlens.operators.decide import Prepared, foreign_peers
from peerlens.operators.ranking import quantiles
from peerlens.operators.records import flag_summary
from peerlens.operators.scratch import Scratch

# The quantiles that are told, and the inliers that count as a clear geometric match.
AT = (0.05, 0.25, 0.5, 0.75, 0.95)
CLEAR_MATCH = 15


def _rounded(values: dict[float, float]) -> dict[str, float | None]:
    return {str(q): None if math.isnan(v) else round(v, 3) for q, v in values.items()}


def sample_quantiles(samples: DataFrame, scratch: Scratch) -> dict[str, dict[float, float]]:
    """The quantiles of each side of the samples (side, x)."""
    found = quantiles(samples, "side", "x", AT, scratch).collect()
    return {r["side"]: dict(zip(AT, r["q"])) for r in found}


def geometry_values(drawn: DataFrame) -> dict[str, float | int]:
    """Pairs, median inliers and share of clear matches of each side of the drawn pairs (side, x); there are few."""
    inliers = F.expm1("x")
    rows = {r["side"]: r for r in drawn.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.expm1(F.median("x")).alias("m"), F.avg((F.round(inliers, 6) >= CLEAR_MATCH).cast("double")).alias("f")).collect()}
    out: dict[str, float | int] = {"n_pairs": max((r["n"] for r in rows.values()), default=0)}
    for side, name in (("pos", "legit"), ("neg", "foreign")):
        if side in rows:
            out |= {f"{name}_median_inliers": rows[side]["m"], f"{name}_frac_ge_15": rows[side]["f"]}
    return out


def calibration(ready: Prepared, ratio: calibrate.Ratio, cfg: Config, scratch: Scratch) -> dict:
    """What the calibration found: sizes, floors, and quantiles of the samples and of the similarities of pairs."""
    sides = sample_quantiles(ready.samples, scratch)
    _, foreign = foreign_peers(ready.reps, ready.scores, cfg)
    asking = ready.reps.join(ready.scores.where("n_scored >= 2").select("grp").distinct(), "grp", "left_semi")
    out = {
        "n_legit": ratio.n_pos, "n_foreign": ratio.n_neg, "floor": ratio.floor(cfg.gate.p_thresh), "p_thresh": cfg.gate.p_thresh,
        "legit_consensus_quantiles": _rounded(sides["pos"]), "foreign_consensus_quantiles": _rounded(sides["neg"]),
        "within_pair_quantiles": _rounded(consensus.pair_quantiles(asking.select("grp", "item", "vec"), list(AT))),
        "cross_pair_quantiles": _rounded(consensus.pair_quantiles(asking.select("grp", "item", "vec"), list(AT), foreign)),
        "embedder": cfg.embedder, "support_floor": ratio.support_floor,
    }
    if ready.drawn is not None:
        out["geometry"] = geometry_values(ready.drawn)
    return out


def flags(decided: DataFrame) -> dict:
    """How many items are flagged, in how many groups, and of which kinds."""
    rows = {r["kind"]: r for r in flag_summary(decided).collect()}
    every = rows.pop("all", None)
    return {"n_flagged": every["n_flagged"] if every else 0, "n_outlets_with_flags": every["n_groups"] if every else 0, "by_kind": {k: rows[k]["n_flagged"] for k in sorted(rows)}}


def write_calibration(path: str, found: dict, decided: DataFrame, folders: DataFrame, cfg: Config) -> None:
    """One local JSON file of ``found``, the flags and the groups to review; their names are streamed, however many there are."""
    head = json.dumps(found | {"flag_summary": flags(decided)}, indent=2)
    with open(path, "w", encoding="utf-8") as f:
        f.write(head[:-2] + ',\n  "folder_review": {\n    "floor": ' + json.dumps(cfg.gate.folder_review_floor) + ',\n    "outlets": [')
        for i, r in enumerate(folders.where("review").select("grp").orderBy("grp").toLocalIterator()):
            f.write(("," if i else "") + "\n      " + json.dumps(r["grp"], ensure_ascii=False))
        f.write("\n    ]\n  }\n}\n")


def run_summary(rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(z, pool, n_scored, n_foreign, ap_raw, ap_gated) of the pooled rows of a harness; what is no candidate scores 0 in ap_gated."""
    keys = ["z", "pool"]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_scored"), F.count_if("label").alias("n_foreign"))
    gated = F.when(F.col("candidate"), F.coalesce("score", F.lit(0.0))).otherwise(0.0)
    raw = harness.average_precision(rows, keys, scratch).withColumnRenamed("ap", "ap_raw")
    cut = harness.average_precision(rows.withColumn("score", gated), keys, scratch).withColumnRenamed("ap", "ap_gated")
    return counts.join(raw, keys, "left").join(cut, keys, "left").na.fill(0.0, ["ap_raw", "ap_gated"])


def evaluation(summary: DataFrame, table: DataFrame, best: DataFrame, found: dict, cfg: Config) -> dict:
    """The document of an evaluation: each run with its table, the calibration and the operating point."""
    how, name = cfg.harness, f"f{cfg.harness.beta:g}"
    runs = {
        f"z={r['z']}|{r['pool']}": {"n_scored": r["n_scored"], "n_foreign": r["n_foreign"], "ap_raw": r["ap_raw"], "ap_gated": r["ap_gated"], "table": []}
        for r in summary.orderBy("z", "pool").collect()
    }
    for r in table.orderBy("z", "pool", "threshold").collect():
        runs[f"z={r['z']}|{r['pool']}"]["table"].append({c: r[c] for c in ("threshold", "precision", "recall", "f1", "n_flagged")} | {name: r["f_beta"]})
    point = harness.operating_point(best, how.select_mode).first()
    return {
        "thresholds": list(harness.THRESHOLDS), "runs": runs, "calibration": found,
        "operating_point": {"run": f"z={point['z']}|{how.select_mode}", "z_thresh": point["z"], "threshold": point["threshold"], "precision": point["precision"], "recall": point["recall"], name: point["f_beta"]},
    }


def told(document: dict) -> Iterator[str]:
    """A line for each run of an evaluation."""
    for name, r in document["runs"].items():
        yield f"{name}: n={r['n_scored']} foreign={r['n_foreign']} ap_raw={r['ap_raw']:.3f} ap_gated={r['ap_gated']:.3f}"
