"""Command line: ``run`` scores a dataset, ``evaluate`` measures it by transplants, ``profile`` counts it."""

from __future__ import annotations

import argparse
import dataclasses
import json
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.config import Config, set_values
from peerlens.functions.hashing import content_key
from peerlens.functions.text import extension
from peerlens.operators import consensus, decide, documents, duplicates, harness, page, profile, records
from peerlens.operators.explain import reason, tags_of, with_tags, with_text
from peerlens.operators.scratch import Scratch


def _session() -> SparkSession:
    return SparkSession.builder.appName("peerlens").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _settings(spark: SparkSession, args) -> Config:
    """The settings of the file, with what the options say instead."""
    cfg = Config.load(args.config) if args.config else Config()
    if args.embedder:
        cfg = dataclasses.replace(cfg, embedder=args.embedder)
    if args.no_geometry:
        cfg = dataclasses.replace(cfg, geometry=dataclasses.replace(cfg.geometry, enabled=False))
    if getattr(args, "no_ocr", False):
        cfg = dataclasses.replace(cfg, ocr=dataclasses.replace(cfg.ocr, enabled=False))
    # Pixels and vectors go to Python in batches of this many rows.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", args.batch_size or spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    return cfg


def _is_table(path: str) -> bool:
    return path.rstrip("/").endswith(".parquet")


def _inputs(spark: SparkSession, args, cfg: Config) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Items, vectors and paths: Parquet tables, or a directory of images with vectors computed from pixels, once for each content."""
    from peerlens.sources.images import cached_vectors, get_embedder, images, items_of

    paths = None
    if _is_table(args.data):
        items = items_of(spark.read.parquet(args.data))
    else:
        found = images(spark, args.data)
        items, paths = found.select("grp", "item", "sha", "readable", "bits"), found.select("grp", "item", "path")
    if args.vectors:
        vectors = _by_content(spark, args.vectors).select("sha", "vec")
    else:
        vectors = cached_vectors(spark, args.data, items, get_embedder(cfg.embedder), cfg.cache_dir)
    return items, vectors, paths


def _by_content(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with its content hash as ``sha``, read as in the items; the column is ``sha``, ``sha256`` or ``key``."""
    rows = spark.read.parquet(path)
    name = next(c for c in ("sha", "sha256", "key") if c in rows.columns)
    return rows.withColumnRenamed(name, "sha").withColumn("sha", content_key(F.col("sha")))


def _features(spark: SparkSession, args) -> DataFrame | None:
    if not args.features:
        return None
    # One row counts of each content, so no pair is matched twice.
    one = _by_content(spark, args.features).where("sha is not null").groupBy("sha").agg(F.max(F.struct("points", "descriptors")).alias("f"))
    return one.select(F.col("sha").alias("key"), "f.points", "f.descriptors")


def run(args) -> None:
    spark = _session()
    cfg = _settings(spark, args)
    items, vectors, paths = _inputs(spark, args, cfg)
    scratch = Scratch(spark, "run")
    decided, ready, ratio = decide.audit(items, vectors, cfg, scratch, _features(spark, args))
    floor = ratio.floor(cfg.gate.p_thresh)
    extra = []
    if args.tag_vectors and not args.no_tags:
        tags = tags_of(_by_content(spark, args.tag_vectors), spark.read.parquet(args.prompts), args.tag_scale)
        decided, said = with_tags(decided, ready.reps, scratch.save(tags, "tags"), cfg.tags.min_conf)
        extra += said
    if args.texts and cfg.ocr.enabled:
        decided, said = with_text(decided, ready.reps, ready.scores, _by_content(spark, args.texts), cfg.ocr.peers, cfg.ocr.min_conf)
        extra += said
    decided = scratch.save(decided.withColumn("reason", F.when(F.col("flagged"), reason(floor, ratio.support_floor, extra))), "decided")
    folders = consensus.folders(ready.scores, cfg.gate)
    result = records.group_records(decided, folders)
    os.makedirs(args.out, exist_ok=True)
    records.write_json(result, f"{args.out}/results_json")
    records.write_csv(records.csv_records(result), f"{args.out}/results_csv")
    records.write_csv(records.item_rows(decided), f"{args.out}/images_csv")
    if args.single:
        records.write_json_document(result, f"{args.out}/{cfg.output.json}")
    found = documents.calibration(ready, ratio, cfg, scratch)
    documents.write_calibration(f"{args.out}/calibration.json", found, decided, folders, cfg)
    if args.report:
        page.write_page(f"{args.out}/{cfg.output.html}" if args.report is True else args.report, decided, ready, folders, found, cfg, scratch, paths)
    print(json.dumps({"floor": floor, "support_floor": ratio.support_floor, "n_pos": ratio.n_pos, "n_neg": ratio.n_neg} | documents.flags(decided)))


def evaluate(args) -> None:
    spark = _session()
    cfg = _settings(spark, args)
    items, vectors, _ = _inputs(spark, args, cfg)
    features = _features(spark, args)
    scratch = Scratch(spark, "evaluate")
    _, ready, ratio = decide.audit(items, vectors, cfg, scratch, features)
    rows = scratch.save(harness.pooled(harness.run(items, vectors, ready, ratio, cfg, scratch, features)), "pooled")
    table = scratch.save(harness.pr_table(rows, ["z", "pool"], beta=cfg.harness.beta), "table")
    best = harness.best_threshold(table, ["z", "pool"])
    document = documents.evaluation(documents.run_summary(rows, scratch), table, best, documents.calibration(ready, ratio, cfg, scratch), cfg)
    point = document["operating_point"]
    os.makedirs(args.out, exist_ok=True)
    with open(f"{args.out}/eval_{cfg.embedder}{'' if cfg.geometry.enabled else '_nogeom'}.json", "w", encoding="utf-8") as f:
        json.dump(document, f, indent=2)
    print("\n".join(documents.told(document)))
    chosen = table.where((F.col("z") == point["z_thresh"]) & (F.col("pool") == cfg.harness.select_mode)).orderBy("threshold").collect()
    print(records.pr_markdown(chosen, cfg.harness.beta))
    print(json.dumps(point))
    if args.write_threshold:
        set_values(args.config, {"z_thresh": point["z_thresh"], "p_thresh": point["threshold"]})


def profiled(args) -> None:
    from peerlens.sources.images import images, items_of

    spark, cfg = _session(), Config()
    scratch = Scratch(spark, "profile")
    if _is_table(args.data):
        items, files = scratch.save(items_of(spark.read.parquet(args.data)), "items"), None
    else:
        files = scratch.save(images(spark, args.data), "items")
        items = files.select("grp", "item", "sha", "readable", "bits")
    copies = duplicates.copy_groups(items, cfg.dedup.near_dup_hamming, scratch)
    found = profile.group_sizes(items).first().asDict() | profile.copy_counts(items, copies).first().asDict()
    if files is not None:
        found |= profile.file_counts(files).first().asDict()
        found["resolutions"] = [r.asDict() for r in profile.top_values(files.where("readable").select(F.concat_ws("x", "width", "height").alias("size")), "size").collect()]
        found["formats"] = [r.asDict() for r in profile.top_values(files.select(extension(F.col("path")).alias("format")), "format").collect()]
        found["first_unreadable"] = [f"{r['grp']}/{r['item']}" for r in files.where("not readable").orderBy("grp", "item").limit(5).collect()]
    print(json.dumps(found, default=str))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="peerlens")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, f in (("run", run), ("evaluate", evaluate), ("profile", profiled)):
        p = sub.add_parser(name)
        p.set_defaults(f=f)
        p.add_argument("--data", required=True, help="directory of groups of images, or a Parquet table of them")
        p.add_argument("--log-level", default="WARNING")
        if name == "profile":
            continue
        p.add_argument("--vectors", help="Parquet table of vectors by content hash")
        p.add_argument("--embedder", choices=("phash", "dinov2", "clip"), help="name of the model of the vectors; phash is computed where there is no table")
        p.add_argument("--out", default="out")
        p.add_argument("--config")
        p.add_argument("--device", default="auto", choices=("auto", "cpu", "cuda"), help="taken for compatibility; no model runs here")
        p.add_argument("--batch-size", type=int, help="rows that go to Python together")
        p.add_argument("--no-geometry", action="store_true")
        p.add_argument("--features", help="Parquet table of local features by content hash: key, points, descriptors")
        if name == "run":
            p.add_argument("--tag-vectors", help="Parquet table of vectors by content hash that are held against the prompts")
            p.add_argument("--prompts", help="Parquet table of the prompts' vectors: kind (scene or brand), label, vec")
            p.add_argument("--tag-scale", type=float, default=100.0, help="factor of the similarities before the softmax")
            p.add_argument("--no-tags", action="store_true")
            p.add_argument("--texts", help="Parquet table of recognised text by content hash: texts array<struct<text, conf>>")
            p.add_argument("--no-ocr", action="store_true")
            p.add_argument("--report", nargs="?", const=True, help="write a page of the most suspicious items, there or under the name of the settings")
            p.add_argument("--single", action="store_true", help="write the records as one JSON document besides")
        if name == "evaluate":
            p.add_argument("--write-threshold", action="store_true")
    args = parser.parse_args(argv)
    # What can't work is said before anything runs.
    if bool(getattr(args, "tag_vectors", None)) != bool(getattr(args, "prompts", None)):
        parser.error("--tag-vectors and --prompts go together")
    if getattr(args, "write_threshold", False) and not args.config:
        parser.error("--write-threshold needs the --config it is written to")
    if args.command != "profile" and not args.vectors:
        if args.embedder not in (None, "phash"):
            parser.error(f"vectors of {args.embedder} are read, not computed: give --vectors")
        if _is_table(args.data):
            parser.error("a table of items has no pixels: give --vectors")
        args.embedder = "phash"
    logging.basicConfig(level=args.log_level)
    args.f(args)


if __name__ == "__main__":
    main()
