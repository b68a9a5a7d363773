"""Consolidating pairwise matches into groups.

The graph is the photos' contents, linked by verdicts; its components are found
by deterministic Borůvka hooking (``operators.components``): every component
picks its smallest outgoing edge, the trees collapse by pointer doubling, and
the edges are relabelled and deduplicated until none are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.llm.photos import hash_key, photo_records, trimmed
from peerlens.operators.components import connected_components
from peerlens.operators.scratch import Scratch
from peerlens.operators.skew import join_to_one


def photo_groups(images: DataFrame, match_pairs: DataFrame) -> DataFrame:
    """(group_id, image_id) of every record that is linked to another.

    Records with one sha256 are one node, named by their smallest image_id, so
    a hash held by any share of the records adds no pairs; ``match_pairs`` rows
    with verdict ``match`` are edges between the nodes of their two hashes.
    group_id is the smallest image_id of the group.  Unknown and null ends link
    nothing; a record without a sha256 is linked to nothing.
    """
    scratch = Scratch(images.sparkSession, "groups")
    records = scratch.save(photo_records(images).where(F.col("sha").isNotNull()).select("sha", "image_id"), "records")
    nodes = scratch.save(records.groupBy("sha").agg(F.min("image_id").alias("node"), F.count(F.lit(1)).alias("size")), "nodes")
    agreed = match_pairs.where(trimmed(F.col("verdict")) == "match").select(hash_key(F.col("sha256_a")).alias("a"), hash_key(F.col("sha256_b")).alias("b"))
    agreed = agreed.where("a is not null and b is not null and a <> b").distinct()
    at_a = nodes.select(F.col("sha").alias("a"), F.col("node").alias("na"))
    at_b = nodes.select(F.col("sha").alias("b"), F.col("node").alias("nb"))
    found = connected_components(agreed.join(at_a, "a").join(at_b, "b").select("na", "nb"), "na", "nb", scratch)
    least = found.groupBy("root").agg(F.min("node").alias("group_id"))
    label = join_to_one(found, least, ["root"], scratch).select("node", "group_id")
    grouped = nodes.join(label, "node", "left").where("size > 1 or group_id is not null")
    grouped = scratch.save(grouped.select("sha", "node", F.coalesce("group_id", "node").alias("group_id"), "size"), "grouped")
    # A node of one record is that record; only shared hashes go back to the records.
    single = grouped.where("size = 1").select("group_id", F.col("node").alias("image_id"))
    shared = join_to_one(records, grouped.where("size > 1").select("sha", "group_id"), ["sha"], scratch).select("group_id", "image_id")
    return single.unionByName(shared)
