"""From similarities to a decision for every item.

One plan over all groups: copies are set aside, representatives are scored
against their group, candidates are looked at closer (geometry, subgroups), and
the fixed policies for copies and unreadable items come last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.config import Config
from peerlens.functions.vectors import unit
from peerlens.operators import calibrate, consensus, duplicates
from peerlens.operators.geometry import best_peer, evidence_value, inliers
from peerlens.operators.ranking import ranked, suspicion_order
from peerlens.operators.scratch import Scratch


@dataclass
class Prepared:
    """What all scoring starts from; every table is stored."""

    items: DataFrame  # grp, item, sha, readable, bits
    copies: DataFrame  # grp, item, root, rep, is_rep, size
    reps: DataFrame  # grp, item, sha, vec
    scores: DataFrame  # grp, item, n_peers, s, median_s, n_scored, mad, z
    samples: DataFrame | None = None  # side, x: what an audit was calibrated on
    geom: calibrate.Ratio | None = None  # the calibration of geometric evidence, where the audit had features
    drawn: DataFrame | None = None  # side, x, inliers: what that was calibrated on


def prepare(items: DataFrame, vectors: DataFrame, cfg: Config, scratch: Scratch) -> Prepared:
    """Copies, representatives with their unit vectors, and consensus of ``items`` with ``vectors`` (sha, vec).

    Items without a group or name are left out; of rows with one group and name
    one counts.  An item whose content has no usable vector isn't scored.
    """
    items = items.where("grp is not null and item is not null").select("grp", "item", "sha", "readable", "bits")
    one = F.max(F.struct(F.coalesce("readable", F.lit(False)).alias("readable"), "sha", "bits"))
    items = scratch.save(items.groupBy("grp", "item").agg(one.alias("r")).select("grp", "item", "r.sha", "r.readable", "r.bits"), "items")
    copies = scratch.save(duplicates.copy_groups(items, cfg.dedup.near_dup_hamming, scratch), "copies")
    vectors = vectors.where("sha is not null").groupBy("sha").agg(F.min(unit(F.col("vec"))).alias("vec")).where("vec is not null")
    reps = duplicates.readable_representatives(items, copies).select("grp", "item", "sha").join(vectors, "sha").select("grp", "item", "sha", "vec")
    reps = scratch.save(reps, "reps")
    return Prepared(items, copies, reps, scores_of(reps, cfg, scratch))


def scores_of(reps: DataFrame, cfg: Config, scratch: Scratch) -> DataFrame:
    return scratch.save(consensus.modified_z(consensus.consensus(reps, how=cfg.consensus), cfg.gate.mad_floor, scratch), "scores")


def samples(reps: DataFrame, scores: DataFrame, cfg: Config, seed: int | None = None) -> DataFrame:
    """(side, x): consensus of items that look at home, and similarity of items to a foreign group.

    Groups of two items or more take part; each is held against one other.
    """
    at_home = scores.where((F.col("n_scored") >= 2) & F.col("s").isNotNull() & (F.col("z") >= -cfg.gate.z_thresh))
    asking, foreign = foreign_peers(reps, scores, cfg, seed)
    against = consensus.consensus(asking, foreign, cfg.consensus)
    return at_home.select(F.lit("pos").alias("side"), F.col("s").alias("x")).unionByName(against.where("s is not null").select(F.lit("neg").alias("side"), F.col("s").alias("x")))


def foreign_peers(reps: DataFrame, scores: DataFrame, cfg: Config, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(grp, item, vec, …) of the groups of two items or more, and (grp, item, vec) of the group that each of them is held against."""
    groups = scores.where("n_scored >= 2").select("grp").distinct()
    drawn = calibrate.donors(groups, cfg.seed if seed is None else seed)
    foreign = drawn.join(reps.withColumnRenamed("grp", "donor"), "donor").select("grp", "item", "vec")
    return reps.join(groups, "grp", "left_semi"), foreign


def gate(reps: DataFrame, scores: DataFrame, ratio: calibrate.Ratio, cfg: Config, scratch: Scratch, seen: DataFrame | None = None, geom: calibrate.Ratio | None = None) -> DataFrame:
    """(grp, item, s, z, …, p, candidate, flagged, kind, geom_*, sub_*) of every scored item.

    ``seen`` (grp, item, pos, peer, inliers) with its calibration ``geom`` is
    the geometric evidence of candidates in groups of three or more.
    """
    scored = calibrate.with_posterior(scores, ratio, "s", "p")
    scored = scored.withColumn("candidate", consensus.candidate(F.col("n_scored"), F.col("z"), F.col("p"), cfg.gate))
    scored = scratch.save(scored, "candidates")
    closer = scored.where("candidate and n_scored >= 3").select("grp", "item", "s")
    if seen is not None and geom is not None:
        seen = best_peer(seen.join(closer.select("grp", "item"), ["grp", "item"], "left_semi")).withColumn("x", evidence_value(F.col("inliers")))
        seen = calibrate.with_log_lr(seen, geom, "x", "geom_log_lr").select("grp", "item", F.col("inliers").alias("geom_inliers"), F.col("peer").alias("geom_peer"), "geom_log_lr")
        scored = calibrate.with_posterior(scored.drop("p").join(seen, ["grp", "item"], "left"), ratio, "s", "p", "geom_log_lr")
    else:
        scored = scored.withColumns({"geom_inliers": F.lit(None).cast("int"), "geom_peer": F.lit(None).cast("string"), "geom_log_lr": F.lit(None).cast("double")})
    asking = closer.select("grp", "item").join(reps, ["grp", "item"])
    others = reps.join(closer.select("grp").distinct(), "grp", "left_semi").join(scores.select("grp", "item", "s"), ["grp", "item"])
    sub = consensus.support_groups(asking, others, ratio.support_floor, cfg.gate.min_subgroup_size)
    sub = calibrate.with_posterior(sub, ratio, "s_sub", "p_sub").select(
        "grp", "item", F.col("size").alias("sub_size"), F.col("s_sub").alias("sub_s"), F.col("p_sub").alias("sub_p"), F.col("anchored").alias("sub_anchored"),
    )
    scored = scored.join(sub, ["grp", "item"], "left").withColumn("p", F.when(F.col("sub_anchored"), F.col("p") * F.col("sub_p")).otherwise(F.col("p")))
    flagged = F.coalesce(F.col("candidate") & (F.col("p") >= cfg.gate.p_thresh), F.lit(False))
    return scored.withColumn("flagged", flagged).withColumn("kind", F.when(flagged & (F.col("n_scored") == 2), "pair").otherwise("scored"))


def resolve(ready: Prepared, gated: DataFrame, cfg: Config, across: bool = True) -> DataFrame:
    """One row per item with kind, suspicion and flagged after the policies: unreadable, then copies across groups, then copies, then its score.

    A missing score is null and never flags; a copy of an item without a score
    has the policy's suspicion.
    """
    rep = gated.select("grp", F.col("item").alias("rep"), F.col("p").alias("rep_p"), F.col("flagged").alias("rep_flagged"))
    own = gated.select(
        "grp", "item", "s", "z", "n_scored", "median_s", "p", "candidate", "flagged", "kind", "geom_inliers", "geom_peer", "geom_log_lr", "sub_size", "sub_s", "sub_p", "sub_anchored",
    ).withColumnsRenamed({"kind": "own_kind", "flagged": "own_flagged"})
    rows = ready.items.select("grp", "item", "sha", "readable").join(ready.copies.select("grp", "item", "rep", "is_rep"), ["grp", "item"])
    rows = rows.join(own, ["grp", "item"], "left").join(rep, ["grp", "rep"], "left")
    if across:
        rows = rows.join(duplicates.cross_group_copies(ready.items), ["grp", "item"], "left")
    else:
        rows = rows.withColumns({"other_grp": F.lit(None).cast("string"), "other_item": F.lit(None).cast("string")})
    unreadable, crossed, copy = ~F.col("readable"), F.col("other_grp").isNotNull(), ~F.col("is_rep")
    base = F.when(copy, F.greatest(F.lit(cfg.policy.duplicate_suspicion), "rep_p")).otherwise(F.col("p"))
    suspicion = F.when(unreadable, F.lit(cfg.policy.unreadable_suspicion)).when(crossed, F.greatest(base, F.lit(cfg.policy.cross_outlet_duplicate_suspicion))).otherwise(base)
    kind = F.when(unreadable, "unreadable").when(crossed, "cross_duplicate").when(copy, "duplicate").otherwise(F.coalesce("own_kind", F.lit("scored")))
    flagged = unreadable | crossed | copy | F.coalesce("own_flagged", F.lit(False))
    read_copy = copy & ~unreadable
    return rows.select(
        "grp", "item", "sha", kind.alias("kind"), suspicion.alias("suspicion"), flagged.alias("flagged"), F.coalesce("candidate", F.lit(False)).alias("candidate"),
        "s", "z", "n_scored", "median_s", F.when(read_copy, F.col("rep")).alias("dup_of"), F.when(read_copy, F.coalesce("rep_flagged", F.lit(False))).alias("rep_flagged"),
        F.when(~unreadable, F.col("other_grp")).alias("other_grp"), F.when(~unreadable, F.col("other_item")).alias("other_item"),
        "geom_inliers", "geom_peer", "geom_log_lr", "sub_size", "sub_s", "sub_p", "sub_anchored",
    )


def counted_inliers(peers: DataFrame, reps: DataFrame, features: DataFrame, cfg: Config) -> DataFrame:
    """(grp, item, pos, peer, inliers) of (grp, item, sha, pos, peer, peer_sha); a pair of contents is matched once."""
    matched = inliers(peers.select(F.col("sha").alias("a"), F.col("peer_sha").alias("b")), features, cfg.geometry)
    keyed = peers.withColumns({"a": F.least("sha", "peer_sha"), "b": F.greatest("sha", "peer_sha")})
    return keyed.join(matched, ["a", "b"]).select("grp", "item", "pos", "peer", "inliers")


def geometric_evidence(asking: DataFrame, reps: DataFrame, scores: DataFrame, features: DataFrame, floor: float, cfg: Config) -> DataFrame:
    """Inliers of the asking items (grp, item) with their most similar peers of consensus ``floor`` or more and the most typical of their group."""
    at = reps.join(asking.select("grp", "item"), ["grp", "item"], "left_semi")
    supported = reps.join(scores.where(F.col("s") >= floor).select("grp", "item"), ["grp", "item"], "left_semi")
    peers = consensus.peers_to_verify(at.select("grp", "item", "vec"), supported.select("grp", "item", "vec"), scores, cfg.geometry.peers, cfg.geometry.typical_peers)
    named = peers.join(reps.select("grp", "item", "sha"), ["grp", "item"]).join(reps.select("grp", F.col("item").alias("peer"), F.col("sha").alias("peer_sha")), ["grp", "peer"])
    return counted_inliers(named, reps, features, cfg)


def seen_by_candidates(reps: DataFrame, scores: DataFrame, ratio: calibrate.Ratio, features: DataFrame, cfg: Config) -> DataFrame:
    """The geometric evidence (grp, item, pos, peer, inliers) of all candidates in groups of three or more."""
    first = calibrate.with_posterior(scores, ratio, "s", "p")
    closer = first.where((F.col("n_scored") >= 3) & consensus.candidate(F.col("n_scored"), F.col("z"), F.col("p"), cfg.gate))
    return geometric_evidence(closer, reps, scores, features, ratio.support_floor, cfg)


def geometry_samples(reps: DataFrame, scores: DataFrame, features: DataFrame, cfg: Config, scratch: Scratch) -> DataFrame:
    """(side, x): the geometric value of drawn items against peers of their own group and of another group.

    ``calib_pairs`` draws with replacement, by hash, among groups with more
    items than peers wanted; items and groups are numbered in hash order, so a
    draw is a join on a number.
    """
    how = cfg.geometry
    groups = scores.where(F.col("n_scored") > how.peers).select("grp").distinct()
    order = [calibrate.hashed_order(cfg.seed, "number", "grp").asc()]
    numbered = ranked(groups.withColumn("one", F.lit("all")), "one", order, "no", scratch).drop("one")
    total = numbered.count()
    if total < 2:
        raise ValueError("geometry needs two groups with more items than peers")
    draw = reps.sparkSession.range(how.calib_pairs).select(F.col("id").cast("string").alias("draw"), (F.pmod(F.xxhash64("id", F.lit(cfg.seed)), F.lit(total)) + 1).cast("int").alias("no"))
    pairs = numbered.join(calibrate.donors(groups, cfg.seed, "geometry"), "grp")
    drawn = scratch.save(draw.join(pairs, "no").join(scores.groupBy("grp").agg(F.max("n_scored").alias("n")), "grp").select("draw", "grp", "donor", "n"), "draws")
    members = ranked(reps.join(drawn.select("grp").distinct(), "grp", "left_semi"), "grp", [calibrate.hashed_order(cfg.seed, "number", "grp", "item").asc()], "no", scratch)
    chosen = drawn.withColumn("no", (F.pmod(F.xxhash64("draw", F.lit(cfg.seed + 1)), F.col("n")) + 1).cast("int")).join(members, ["grp", "no"])
    chosen = scratch.save(chosen.select("draw", "grp", "donor", "item", "sha", "vec"), "chosen")
    sides = []
    for side, other in (("pos", "grp"), ("neg", "donor")):
        pool = chosen.select("draw", F.col(other).alias("from"), F.col("grp").alias("home"), F.col("item").alias("own")).join(reps.withColumnRenamed("grp", "from"), "from")
        # Names carry their group, so a foreign item of the same name isn't taken for the item itself.
        pool = pool.select(F.col("draw").alias("grp"), F.concat_ws("/", "from", "item").alias("item"), "vec", "sha", "from", F.col("item").alias("name"))
        asking = chosen.select(F.col("draw").alias("grp"), F.concat_ws("/", "grp", "item").alias("item"), "vec", "sha")
        typical = pool.join(scores.select(F.col("grp").alias("from"), F.col("item").alias("name"), "s"), ["from", "name"]).select("grp", "item", "s")
        peers = consensus.peers_to_verify(asking.select("grp", "item", "vec"), pool.select("grp", "item", "vec"), typical, how.peers, how.typical_peers)
        named = peers.join(asking.select("grp", "item", "sha"), ["grp", "item"]).join(pool.select("grp", F.col("item").alias("peer"), F.col("sha").alias("peer_sha")), ["grp", "peer"])
        best = best_peer(counted_inliers(named, reps, features, cfg))
        sides.append(best.select(F.lit(side).alias("side"), evidence_value(F.col("inliers")).alias("x"), "inliers"))
    return sides[0].unionByName(sides[1])


def audit(items: DataFrame, vectors: DataFrame, cfg: Config | None = None, scratch: Scratch | None = None, features: DataFrame | None = None) -> tuple[DataFrame, Prepared, calibrate.Ratio]:
    """Every item's decision with its rank in its group, what it came from, and the calibration.

    ``features`` (``geometry.FEATURES``, by sha) adds geometric evidence.
    """
    cfg = cfg or Config()
    scratch = scratch or Scratch(items.sparkSession, "audit")
    ready = prepare(items, vectors, cfg, scratch)
    ready.samples = scratch.save(samples(ready.reps, ready.scores, cfg), "samples")
    ratio = calibrate.fit(ready.samples, cfg.gate.prior_outlier_rate)
    seen = geom = None
    if features is not None and cfg.geometry.enabled:
        ready.drawn = scratch.save(geometry_samples(ready.reps, ready.scores, features, cfg, scratch), "geometry-samples")
        ready.geom = geom = calibrate.fit(ready.drawn, cfg.gate.prior_outlier_rate)
        seen = scratch.save(seen_by_candidates(ready.reps, ready.scores, ratio, features, cfg), "inliers")
    gated = scratch.save(gate(ready.reps, ready.scores, ratio, cfg, scratch, seen, geom), "gated")
    decided = resolve(ready, gated, cfg)
    return ranked(decided, "grp", suspicion_order(), scratch=scratch), ready, ratio
