"""Results in the shapes they are handed over in."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Items in one piece of a group's record.
PIECE = 10_000


def group_records(decided: DataFrame, folders: DataFrame, piece: int = PIECE) -> DataFrame:
    """Nested records of each group: size, flagged items with score and reason, ranking, median consensus and review.

    ``decided`` has grp, item, rank, suspicion, flagged, reason.  A group of
    more than ``piece`` items comes in several records, by rank, numbered from 0
    in ``piece``; ``total_images`` is of the whole group in each.
    """
    entry = F.struct(F.col("item").alias("file_name"), F.round("suspicion", 4).alias("suspicion_score"), F.col("reason").alias("reason"))
    one = decided.groupBy("grp", F.floor((F.col("rank") - 1) / piece).cast("int").alias("piece")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.when(F.col("flagged"), F.struct("rank", entry.alias("e"))))).alias("f"),
        F.array_sort(F.collect_list(F.struct("rank", "item"))).alias("r"),
    )
    total = one.groupBy("grp").agg(F.sum("n").cast("int").alias("total_images"))
    return one.join(total, "grp").join(folders.select("grp", "median_s", "review"), "grp", "left").select(
        F.col("grp").alias("outlet_id"), "piece", "total_images", F.transform("f", lambda x: x["e"]).alias("flagged_images"), F.transform("r", lambda x: x["item"]).alias("ranking"),
        F.round("median_s", 3).alias("folder_median_consensus"), F.coalesce("review", F.lit(False)).alias("review_folder"),
    )


def csv_records(records: DataFrame) -> DataFrame:
    """Flat text columns of the records: lists as JSON, review as 0 or 1, a missing median empty."""
    return records.select(
        "outlet_id", "piece", "total_images", F.size("flagged_images").alias("n_flagged"), F.to_json("flagged_images").alias("flagged_images"), F.to_json("ranking").alias("ranking"),
        F.coalesce(F.col("folder_median_consensus").cast("string"), F.lit("")).alias("folder_median_consensus"), F.col("review_folder").cast("int").alias("review_folder"),
    )


def item_rows(decided: DataFrame) -> DataFrame:
    """One row per item with fixed decimals; missing numbers are written ``nan``."""
    fixed = lambda c, d: F.when(F.col(c).isNull(), "nan").otherwise(F.format_string(f"%.{d}f", F.col(c)))
    return decided.select(
        F.col("grp").alias("outlet_id"), F.col("item").alias("file_name"), "rank", fixed("suspicion", 4).alias("suspicion_score"), F.col("flagged").cast("int").alias("flagged"),
        "kind", fixed("s", 3).alias("consensus"), fixed("z", 2).alias("z"), F.coalesce("reason", F.lit("")).alias("reason"),
    )


def flag_summary(decided: DataFrame) -> DataFrame:
    """(kind, n_flagged, n_groups) of flagged items, and over all kinds under ``all``; counted once by grouping sets."""
    flagged = decided.where("flagged")
    return flagged.cube("kind").agg(F.count(F.lit(1)).alias("n_flagged"), F.count_distinct("grp").alias("n_groups")).withColumn("kind", F.coalesce("kind", F.lit("all")))


def review_folders(folders: DataFrame) -> DataFrame:
    return folders.where("review").select("grp", F.round("median_s", 3).alias("median_s"))


def write_json(records: DataFrame, path: str) -> None:
    """One JSON record a line, in parallel files."""
    records.write.mode("overwrite").json(path)


def write_json_document(records: DataFrame, path: str) -> None:
    """A single JSON array in one local file, written record by record in the order of the groups."""
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, r in enumerate(records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j"), "outlet_id", "piece").orderBy("outlet_id", "piece").toLocalIterator()):
            f.write((",\n" if i else "\n") + json.dumps(json.loads(r["j"]), ensure_ascii=False, indent=2))
        f.write("\n]\n")


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def pr_markdown(table: list, beta: float) -> str:
    """A Markdown table of rows with threshold, n_flagged, precision, recall, f1 and f_beta."""
    head = f"| threshold | flagged | precision | recall | F1 | F{beta:g} |\n|-|-|-|-|-|-|\n"
    return head + "\n".join(f"| {r['threshold']:.2f} | {r['n_flagged']} | {r['precision']:.3f} | {r['recall']:.3f} | {r['f1']:.3f} | {r['f_beta']:.3f} |" for r in table)
