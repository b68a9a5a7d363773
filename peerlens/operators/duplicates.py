"""Copies inside groups and across them.

Items are rows (grp, item, sha, readable, bits): ``sha`` a content key, ``bits``
a 32-byte perceptual hash or null.  Two items of a group are copies when they
share the sha or their bits differ in at most ``near`` places, directly or
through other items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.functions.aggregates import smallest
from peerlens.operators.blocks import candidate_pairs, verified
from peerlens.operators.components import connected_components
from peerlens.operators.scratch import Scratch
from peerlens.operators.skew import join_to_one


def content_index(items: DataFrame) -> DataFrame:
    """(sha, n_items, n_groups, first_grp, first_item) of every content; unreadable items count too, null sha doesn't."""
    at = F.min(F.struct("grp", "item"))
    return items.where("sha is not null").groupBy("sha").agg(
        F.count(F.lit(1)).alias("n_items"), F.count_distinct("grp").alias("n_groups"), at["grp"].alias("first_grp"), at["item"].alias("first_item"),
    )


def cross_group_copies(items: DataFrame) -> DataFrame:
    """(grp, item, other_grp, other_item): items whose content stands under another group as well, and the first such place.

    The two smallest groups that hold a content are enough to name another one
    for each group, so no list of places is ever built.
    """
    held = items.where("sha is not null")
    firsts = held.groupBy("sha", "grp").agg(F.min("item").alias("item"))
    two = firsts.groupBy("sha").agg(smallest(F.struct("grp", "item"), 2).alias("two")).where(F.size("two") == 2)
    other = F.when(F.col("grp") == F.col("two")[0]["grp"], F.col("two")[1]).otherwise(F.col("two")[0])
    return held.select("sha", "grp", "item").join(two, "sha").select("grp", "item", other["grp"].alias("other_grp"), other["item"].alias("other_item"))


def near_content(items: DataFrame, near: int, scratch: Scratch) -> DataFrame:
    """(grp, bits_a, bits_b): pairs of different hashes in one group that differ in at most ``near`` bits; either may be of any item that has it."""
    inner = Scratch(items.sparkSession, "near-content")
    held = scratch.save(items.where("bits is not null and length(bits) = 32").select("grp", "bits").distinct(), "held")
    named = held.select(F.xxhash64("grp", "bits").alias("id"), "grp", "bits", F.hex("bits").alias("hex"), F.lit(True).alias("fresh"))
    pairs = candidate_pairs(named, near, inner, scope="grp")
    close = scratch.save(verified(pairs, named.select("id", "bits"), near, inner).select("bits_a", "bits_b"), "close")
    inner.close()
    # The candidates came from one group, but a pair of hashes may stand in several.
    at_a = held.select("grp", F.col("bits").alias("bits_a"))
    return close.join(at_a, "bits_a").join(held.select("grp", F.col("bits").alias("bits_b")), ["grp", "bits_b"]).select("grp", "bits_a", "bits_b")


def copy_edges(nodes: DataFrame, near: int, scratch: Scratch) -> DataFrame:
    """(a, b): enough links between the numbered items of ``nodes`` (a stored table of node, grp, sha, bits) to connect all copies of each group.

    Items of one sha, or of one hash, hang on the first of them, so a content
    held by any share of a group adds one link an item.
    """
    links = []
    for key in ("sha", "bits"):
        held = nodes.where(F.col(key).isNotNull() & ((F.length("bits") == 32) if key == "bits" else F.lit(True))).select("grp", key, "node")
        first = held.groupBy("grp", key).agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("grp", key, "b")
        links.append(join_to_one(held, first, ["grp", key], scratch).where("node <> b").select(F.col("node").alias("a"), "b"))
    if near > 0:
        head = nodes.where("bits is not null").groupBy("grp", "bits").agg(F.min("node").alias("node"))
        close = near_content(nodes, near, scratch)
        at_a = head.select("grp", F.col("bits").alias("bits_a"), F.col("node").alias("a"))
        at_b = head.select("grp", F.col("bits").alias("bits_b"), F.col("node").alias("b"))
        links.append(close.join(at_a, ["grp", "bits_a"]).join(at_b, ["grp", "bits_b"]).select("a", "b"))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def numbered(items: DataFrame, scratch: Scratch) -> DataFrame:
    """The items that have a group and a name, stored, each with a number ``node``."""
    rows = items.where("grp is not null and item is not null").select("grp", "item", "sha", F.coalesce("readable", F.lit(False)).alias("readable"), "bits")
    return scratch.save(rows.withColumn("node", F.monotonically_increasing_id()), "nodes")


def copy_groups(items: DataFrame, near: int, scratch: Scratch | None = None) -> DataFrame:
    """(grp, item, root, rep, is_rep, size): each item's set of copies, named by its first item, and its representative.

    The representative is the first readable item by name, else the first; an
    item without copies is its own.
    """
    scratch = scratch or Scratch(items.sparkSession, "copies")
    nodes = numbered(items, scratch)
    reached = connected_components(copy_edges(nodes, near, scratch), "a", "b", scratch)
    rooted = nodes.join(reached, "node", "left").select("grp", "item", "readable", F.coalesce("root", "node").alias("set"))
    rooted = scratch.save(rooted, "rooted")
    sets = rooted.groupBy("set").agg(
        F.min("item").alias("root"), F.min(F.struct((~F.col("readable")).alias("last"), "item")).alias("r"), F.count(F.lit(1)).cast("int").alias("size"),
    ).select("set", "root", F.col("r.item").alias("rep"), "size")
    return join_to_one(rooted, sets, ["set"], scratch).select("grp", "item", "root", "rep", (F.col("item") == F.col("rep")).alias("is_rep"), "size")


def readable_representatives(items: DataFrame, copies: DataFrame) -> DataFrame:
    """The rows of ``items`` that represent their copies and can be read."""
    return items.where("readable").join(copies.where("is_rep").select("grp", "item"), ["grp", "item"], "left_semi")
