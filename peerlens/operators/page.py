"""A page of the most suspicious items, to be looked at by people."""

from __future__ import annotations

import base64
import html
import json
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.config import Config
from peerlens.functions.aggregates import smallest
from peerlens.functions.hashing import resized
from peerlens.operators import consensus
from peerlens.operators.decide import Prepared
from peerlens.operators.scratch import Scratch

#: Items on the page, pixels of the longer side of a thumbnail, peers beside each item, and groups named at the top.
ROWS, SIDE, PEERS, NAMED = 300, 220, 2, 200
EVIDENCE = ("s", "z", "dup_of", "rep_flagged", "other_grp", "other_item", "geom_inliers", "geom_peer", "geom_log_lr", "sub_size", "sub_s", "sub_p", "sub_anchored")


def png(pixels: np.ndarray) -> bytes:
    """A PNG of an array (rows, columns, 3) of bytes."""
    rows = np.concatenate([np.zeros((len(pixels), 1), np.uint8), pixels.reshape(len(pixels), -1)], axis=1)
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", pixels.shape[1], pixels.shape[0], 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows.tobytes())) + part(b"IEND", b"")


def thumbnail(bgr: np.ndarray, side: int = SIDE) -> str:
    """A data address of the image, no larger than ``side``."""
    height, width = bgr.shape[:2]
    scale = min(1.0, side / max(height, width))
    size = max(1, round(height * scale)), max(1, round(width * scale))
    planes = [bgr[:, :, min(c, bgr.shape[2] - 1)].astype(np.float64) for c in (2, 1, 0)]
    small = np.stack([np.clip(np.rint(resized(p, *size)), 0, 255) for p in planes], axis=2).astype(np.uint8)
    return "data:image/png;base64," + base64.b64encode(png(small)).decode()


def thumbnails(paths: DataFrame) -> dict[tuple[str, str], str]:
    """The thumbnail of each readable image of (grp, item, path); the caller bounds how many there are."""
    at = [r["path"] for r in paths.where("path is not null").select("path").collect()]
    if not at:
        return {}
    decoded = paths.sparkSession.read.format("image").option("dropInvalid", True).load(sorted(at))

    @F.udf("string")
    def small(height, width, channels, data):
        return thumbnail(np.frombuffer(data, np.uint8).reshape(height, width, channels))

    # The two sources write a path differently; its last two parts are the group and the item.
    parts = F.split("image.origin", "/")
    found = decoded.select(F.element_at(parts, -2).alias("grp"), F.element_at(parts, -1).alias("item"), small("image.height", "image.width", "image.nChannels", "image.data").alias("shown"))
    return {(r["grp"], r["item"]): r["shown"] for r in found.collect()}


def nearest(top: DataFrame, ready: Prepared) -> DataFrame:
    """(grp, item, near): the most similar peers of each item of ``top``, or else the first other items of its group."""
    asking = ready.reps.join(top.select("grp", "item"), ["grp", "item"], "left_semi").select("grp", "item", "vec")
    around = ready.reps.join(top.select("grp").distinct(), "grp", "left_semi").select("grp", "item", "vec")
    like = consensus.top_peers(asking, PEERS + 1, around).where("item <> peer")
    like = like.groupBy("grp", "item").agg(smallest(F.struct("rank", "peer"), PEERS).alias("h")).select("grp", "item", F.transform("h", lambda e: e["peer"]).alias("like"))
    firsts = ready.items.join(top.select("grp").distinct(), "grp", "left_semi").groupBy("grp").agg(smallest(F.col("item"), PEERS + 1).alias("firsts"))
    others = F.slice(F.filter("firsts", lambda x: x != F.col("item")), 1, PEERS)
    return top.select("grp", "item").join(like, ["grp", "item"], "left").join(firsts, "grp", "left").select("grp", "item", F.coalesce("like", others).alias("near"))


def write_page(path: str, decided: DataFrame, ready: Prepared, folders: DataFrame, found: dict, cfg: Config, scratch: Scratch, paths: DataFrame | None = None, most: int = ROWS) -> None:
    """Write the page to a local file: the ``most`` most suspicious flagged items with their reason, peers and evidence.

    ``paths`` (grp, item, path) are the images, where there are any.  The head
    tells how much is flagged and how many groups are to be reviewed, with the
    first of their names.
    """
    evidence = F.to_json(F.struct(*[c for c in EVIDENCE if c in decided.columns]))
    top = decided.where("flagged").orderBy(F.col("suspicion").desc_nulls_last(), "grp", "item").limit(most)
    top = scratch.save(top.select("grp", "item", "kind", "suspicion", "reason", evidence.alias("evidence")), "top")
    shown = scratch.save(top.join(nearest(top, ready), ["grp", "item"]), "shown")
    pictures: dict[tuple[str, str], str] = {}
    if paths is not None:
        wanted = shown.select("grp", F.explode(F.concat(F.array("item"), F.coalesce("near", F.array().cast("array<string>")))).alias("item")).distinct()
        pictures = thumbnails(paths.join(wanted, ["grp", "item"]))
    counts = decided.agg(F.count_if("flagged").alias("n"), F.count_distinct(F.when(F.col("flagged"), F.col("grp"))).alias("g"), F.count_distinct("grp").alias("all")).first()
    review = folders.where("review").select("grp")
    n_review, names = review.count(), [r["grp"] for r in review.orderBy("grp").limit(NAMED).collect()]
    text = lambda x: html.escape(str(x))
    picture = lambda grp, item: f'<figure>{"<img src=" + chr(34) + pictures[grp, item] + chr(34) + ">" if (grp, item) in pictures else ""}<figcaption>{text(item)}</figcaption></figure>'
    with open(path, "w", encoding="utf-8") as f:
        f.write("<!doctype html>\n<html><head><meta charset=utf-8><title>Items that do not belong</title>\n<style>figure{display:inline-block;margin:.2em}small{color:#555}tr{vertical-align:top}</style></head><body>\n")
        f.write(f"<h2>{counts['n']} items flagged in {counts['g']} of {counts['all']} groups</h2>\n")
        if n_review:
            f.write(f"<p>To review as a whole, median agreement below {cfg.gate.folder_review_floor}: {n_review} groups: {text(', '.join(names))}{' and more' if n_review > len(names) else ''}</p>\n")
        f.write(f"<p><small>{text(json.dumps({k: v for k, v in found.items() if not isinstance(v, dict)}))}</small></p>\n<table>\n<tr><th>item<th>peers<th>why</tr>\n")
        for r in shown.orderBy(F.col("suspicion").desc_nulls_last(), "grp", "item").collect():
            score = "" if r["suspicion"] is None else f"{r['suspicion']:.2f}"
            f.write(
                f"<tr><td>{picture(r['grp'], r['item'])}<br>{text(r['grp'])} <b>{score}</b> <small>{text(r['kind'])}</small>"
                f"<td>{''.join(picture(r['grp'], p) for p in r['near'] or [])}<td>{text(r['reason'] or '')}<br><small>{text(r['evidence'])}</small></tr>\n"
            )
        f.write("</table></body></html>\n")
