"""Reasons in words, from evidence columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens.functions.aggregates import smallest
from peerlens.functions.text import overlap, snippet, tokens
from peerlens.functions.vectors import dot, softmax, unit
from peerlens.operators.consensus import typical_peers


# The sentences of a reason.
UNREADABLE = "File could not be decoded as an image."
CROSS_DUPLICATE = "Identical file (content hash match) also submitted under %s/%s; the same photo cannot document two outlets."
DUPLICATE = "Identical copy of %s (content hash match); duplicate submission adds no new evidence of a visit."
DUPLICATE_FLAGGED = " The original copy is itself flagged."
PAIR = "Only 2 usable images and they do not match each other (similarity %.2f < absolute floor %.2f); cannot determine which one is genuine, review both."
STATISTIC = "Median similarity to peers %.2f vs folder median %.2f (modified z = %.1f; absolute floor %.2f)."
SCENE_DIFFERS = "Scene reads as '%s' while %d/%d peers read as '%s'."
SCENE_SAME = "Same scene type as peers ('%s') but not the same place."
BRAND_DIFFERS = "Telecom branding reads '%s' vs '%s' on peers."
TEXT_SHARED = "Signage text '%s' shares %d/%d tokens with outlet signage ('%s')."
TEXT_MISSING = "No readable signage text, while peers show '%s'."
TEXT_ALONE = "Signage text '%s' has no counterpart on peers (no readable peer signage)."
GEOMETRY_NONE = "No geometric match to nearest peers (max %d SIFT inliers)."
GEOMETRY_PARTIAL = "Partial geometric match to %s (%d inliers) was not enough to clear the floor."
SUBGROUP_FOREIGN = "%d other images in this folder resemble it (median similarity %.2f) but none of them matches the rest of the folder either: a coherent group that is foreign as a whole."
SUBGROUP_NOTED = "Note: %d other images in this folder resemble it (median similarity %.2f > support level %.2f), but not enough to clear the gate."


def zero_shot(vectors: DataFrame, key: str, prompts: list[tuple[str, list[float]]], scale: float) -> DataFrame:
    """(key, label, p): the prompt with the greatest softmax of scaled similarity to each vector; equal ones by label.

    The prompts are a list of the caller, so their scores are one expression
    per row and nothing is joined.
    """
    ordered = sorted(prompts)
    scores = F.array(*[F.lit(scale) * dot(F.col("vec"), F.array(*[F.lit(float(x)) for x in v])) for _, v in ordered])
    labels = F.array(*[F.lit(name) for name, _ in ordered])
    shares = vectors.select(key, softmax(scores).alias("shares"))
    top = F.array_max("shares")
    return shares.select(key, F.element_at(labels, F.array_position("shares", top).cast("int")).alias("label"), top.alias("p"))


def majority_of_others(labels: DataFrame) -> DataFrame:
    """(grp, item, label, k, n) from (grp, item, label): the commonest label among the other items of the group, by name among equals, with its count and theirs.

    Taking one item away changes one count by one, so the two commonest labels
    of the group tell every item's answer and no item is paired with another.
    """
    counts = labels.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("c"))
    total = counts.groupBy("grp").agg(F.sum("c").alias("total"))
    # Less its own one, a leading label may fall behind any of those it led by one or less; the three first are enough.
    lead = counts.groupBy("grp").agg(smallest(F.struct((-F.col("c")).alias("c"), "label"), 3).alias("lead"))
    rows = labels.join(lead, "grp").join(total, "grp").where("total > 1")
    less = F.transform("lead", lambda e: F.struct((e["c"] + F.when(e["label"] == F.col("label"), 1).otherwise(0)).alias("c"), e["label"].alias("label")))
    first = F.element_at(F.array_sort(F.filter(less, lambda e: e["c"] < 0)), 1)
    return rows.withColumn("m", first).select("grp", "item", F.col("m.label").alias("label"), (-F.col("m.c")).alias("k"), (F.col("total") - 1).alias("n"))


def peer_text(scores: DataFrame, items: DataFrame, peers: int, asking: DataFrame | None = None) -> DataFrame:
    """(grp, item, texts): the recognised text of the most typical other items of the group; ``items`` is (grp, item, texts), of which all or only the ``asking`` are told."""
    top = typical_peers(scores, peers)
    asking = (items if asking is None else asking).select("grp", "item").join(top, "grp").where("item <> peer")
    first = asking.groupBy("grp", "item").agg(smallest(F.struct("rank", "peer"), peers).alias("h"))
    each = first.select("grp", "item", F.explode("h").alias("e")).select("grp", "item", F.col("e.rank").alias("rank"), F.col("e.peer").alias("peer"))
    texts = items.select("grp", F.col("item").alias("peer"), "texts")
    got = each.join(texts, ["grp", "peer"]).groupBy("grp", "item").agg(F.array_sort(F.collect_list(F.struct("rank", "peer", "texts"))).alias("h"))
    return got.select("grp", "item", F.flatten(F.transform("h", lambda e: e["texts"])).alias("texts"))


def text_clause(own: Column, peers: Column, min_conf: float = 0.3) -> Column:
    """What the recognised text says, or null where neither side has any."""
    mine, theirs = tokens(own, min_conf), tokens(peers, min_conf)
    own, peers = (F.filter(x, lambda e: e["conf"] >= min_conf) for x in (own, peers))
    n, m = F.coalesce(F.size(mine), F.lit(0)), F.coalesce(F.size(theirs), F.lit(0))
    shared = F.format_string(TEXT_SHARED, snippet(own), overlap(mine, theirs), n, snippet(peers))
    return F.when((n > 0) & (m > 0), shared).when(m > 0, F.format_string(TEXT_MISSING, snippet(peers))).when(n > 0, F.format_string(TEXT_ALONE, snippet(own)))


def scene_clause(own: Column, majority: Column, k: Column, n: Column) -> Column:
    return F.when(own != majority, F.format_string(SCENE_DIFFERS, own, k, n, majority)).when(own == majority, F.format_string(SCENE_SAME, majority))


def brand_clause(own: Column, own_p: Column, majority: Column, min_conf: float = 0.5) -> Column:
    named = (own != "none") & (majority != "none") & (own != majority)
    return F.when(named & (own_p >= min_conf), F.format_string(BRAND_DIFFERS, own, majority))


def tags_of(vectors: DataFrame, prompts: DataFrame, scale: float) -> DataFrame:
    """(sha, scene, brand, brand_p) of vectors (sha, vec) by prompts (kind, label, vec) of the kinds ``scene`` and ``brand``; the prompts are few and collected."""
    given = prompts.select("kind", "label", "vec").collect()
    vectors = vectors.where("sha is not null").groupBy("sha").agg(F.min(unit(F.col("vec"))).alias("vec")).where("vec is not null")
    named = {kind: [(r["label"], r["vec"]) for r in given if r["kind"] == kind] for kind in ("scene", "brand")}
    if missing := [kind for kind, found in named.items() if not found]:
        raise ValueError(f"no prompts of kind {' and '.join(missing)}")
    scene, brand = (zero_shot(vectors, "sha", named[kind], scale) for kind in ("scene", "brand"))
    return scene.select("sha", F.col("label").alias("scene")).join(brand.select("sha", F.col("label").alias("brand"), F.col("p").alias("brand_p")), "sha")


def with_tags(decided: DataFrame, reps: DataFrame, tags: DataFrame, min_conf: float = 0.5) -> tuple[DataFrame, list[Column]]:
    """Decided rows with their tags and those of the other scored items of the group, and the clauses on them; ``tags`` is (sha, scene, brand, brand_p)."""
    labels = reps.select("grp", "item", "sha").join(tags, "sha")
    scene = majority_of_others(labels.select("grp", "item", F.col("scene").alias("label"))).select("grp", "item", F.col("label").alias("peer_scene"), F.col("k").alias("scene_k"), F.col("n").alias("scene_n"))
    brand = majority_of_others(labels.select("grp", "item", F.col("brand").alias("label"))).select("grp", "item", F.col("label").alias("peer_brand"))
    out = decided.join(tags, "sha", "left").join(scene, ["grp", "item"], "left").join(brand, ["grp", "item"], "left")
    return out, [scene_clause(F.col("scene"), F.col("peer_scene"), F.col("scene_k"), F.col("scene_n")), brand_clause(F.col("brand"), F.col("brand_p"), F.col("peer_brand"), min_conf)]


def with_text(decided: DataFrame, reps: DataFrame, scores: DataFrame, texts: DataFrame, peers: int, min_conf: float = 0.3) -> tuple[DataFrame, list[Column]]:
    """Decided rows with their recognised text and that of typical peers, and the clause on them; ``texts`` is (sha, texts)."""
    texts = texts.where("sha is not null").groupBy("sha").agg(F.max("texts").alias("texts"))
    held = reps.select("grp", "item", "sha").join(texts, "sha").select("grp", "item", "texts")
    asking = decided.where("flagged and kind = 'scored'").select("grp", "item")
    around = peer_text(scores, held, peers, asking).withColumnRenamed("texts", "peer_texts")
    out = decided.join(texts, "sha", "left").join(around, ["grp", "item"], "left")
    return out, [text_clause(F.col("texts"), F.col("peer_texts"), min_conf)]


def geometry_clause() -> Column:
    none = F.format_string(GEOMETRY_NONE, F.col("geom_inliers"))
    return F.when(F.col("geom_log_lr") > 0, none).when(F.col("geom_log_lr") <= 0, F.format_string(GEOMETRY_PARTIAL, F.col("geom_peer"), F.col("geom_inliers")))


def subgroup_clause(support_floor: float) -> Column:
    others = F.col("sub_size") - 1
    noted = F.format_string(SUBGROUP_NOTED, others, F.col("sub_s"), F.lit(float(support_floor)))
    return F.when(~F.col("sub_anchored"), F.format_string(SUBGROUP_FOREIGN, others, F.col("sub_s"))).when(F.col("sub_anchored"), noted)


def reason(floor: float, support_floor: float, extra: list[Column] | None = None) -> Column:
    """The sentence for each decided row (``decide.resolve``); ``extra`` are clauses after the statistic, null where they don't apply."""
    least = F.lit(float(floor))
    copy = F.concat(F.format_string(DUPLICATE, F.col("dup_of")), F.when(F.col("rep_flagged"), DUPLICATE_FLAGGED).otherwise(""))
    by_evidence = F.concat_ws(" ", F.format_string(STATISTIC, F.col("s"), F.col("median_s"), F.col("z"), least), *(extra or []), geometry_clause(), subgroup_clause(support_floor))
    known = {
        "unreadable": F.lit(UNREADABLE), "cross_duplicate": F.format_string(CROSS_DUPLICATE, F.col("other_grp"), F.col("other_item")),
        "duplicate": copy, "pair": F.format_string(PAIR, F.col("s"), least),
    }
    out = None
    for kind, sentence in known.items():
        out = F.when(F.col("kind") == kind, sentence) if out is None else out.when(F.col("kind") == kind, sentence)
    return out.otherwise(by_evidence)
