"""Deduplicating new batches against all history.

The history is a folder of Parquet tables that only grow: ``contents`` (the
smallest image_id of each sha), ``prints`` (that of each fingerprint, under its
id) and ``blocks``, the rotated block tables, one row (key, id) per block of a
fingerprint; ``records`` is the log of what was accepted.  The first three lie
in parts by their key, so a call reads only the parts that its own keys fall
in, and nothing of the history is hashed, posted or written again.

Each call is one commit: its tables are written under a folder of its own, and
only then a marker is put in place by a rename.  Readers see marked commits of
batches before their own, so a call that failed anywhere leaves nothing behind
that counts, is repeated by just calling again, and a call that is repeated
after it succeeded gives the same rows and writes nothing.

Several pending batches may come in one call: they are looked up together and
accepted in the order of their numbers, with the result of a call for each.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.llm.photos import photo_records
from peerlens.operators.blocks import candidate_pairs, postings, verified
from peerlens.operators.scratch import Scratch, shuffle_files_end_with_the_plan

#: Bits in which near fingerprints may differ.
MAX_DISTANCE = 8
#: Rows of ``blocks`` in one part at the first commit, which fixes the number of parts, and the least and most parts.
PART_ROWS, LEAST_PARTS, MOST_PARTS = 4_000_000, 8, 4096


def _strings(records: DataFrame, fresh: bool) -> DataFrame:
    """(id, bits, hex, fresh) of the distinct fingerprints; the id is a 64-bit hash of the bits."""
    one = records.where(F.col("bits").isNotNull()).select("bits").distinct()
    return one.select(F.xxhash64("bits").alias("id"), "bits", F.hex("bits").alias("hex"), F.lit(fresh).alias("fresh"))


@dataclass(frozen=True)
class Commit:
    """What one call has accepted: its batches, a fingerprint of its rows, and how the store is cut."""

    first: int
    last: int
    rows: int
    mark: int
    parts: int
    max_distance: int

    @property
    def folder(self) -> str:
        return f"{self.first}to{self.last}"


class _Files:
    """The few file operations of the markers, on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(root).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def texts(self, folder: str) -> list[str]:
        """The contents of the JSON files of a folder."""
        if not self.fs.exists(self._path(folder)):
            return []
        out = []
        for status in self.fs.listStatus(self._path(folder)):
            if status.getPath().getName().endswith(".json"):
                stream = self.fs.open(status.getPath())
                try:
                    out.append(bytes(stream.readAllBytes()).decode())
                finally:
                    stream.close()
        return out

    def put(self, path: str, text: str) -> None:
        """The whole file or none: written aside and renamed."""
        aside = self._path(path + ".tmp")
        stream = self.fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(aside, self._path(path)):
            raise OSError(f"cannot put {path} in place")


class History:
    """Accepted records and the keys of their contents and fingerprints below one folder; one writer at a time."""

    _TABLES = {
        "records": "image_id long, batch_no int, sha binary, bits binary",
        "contents": "sha binary, image_id long",
        "prints": "id long, bits binary, image_id long",
        "blocks": "key long, id long",
    }

    def __init__(self, spark: SparkSession, path: str, max_distance: int = MAX_DISTANCE):
        self.spark, self.path, self.k = spark, path.rstrip("/"), max_distance

    def commits(self) -> list[Commit]:
        """The commits that count, in the order of their batches."""
        found = [Commit(**json.loads(t)) for t in _Files(self.spark, self.path).texts(f"{self.path}/commits")]
        if any(c.max_distance != self.k for c in found):
            raise ValueError(f"the history at {self.path} was made for another distance than {self.k}")
        return sorted(found, key=lambda c: c.first)

    def read(self, name: str, commits: list[Commit] | None = None, parts: list[int] | None = None) -> DataFrame:
        """A table of the given commits, or of all; of a table in parts only the rows of ``parts``, if given."""
        commits = self.commits() if commits is None else commits
        schema = self._TABLES[name]
        if not commits or parts == []:
            return self.spark.createDataFrame([], schema)
        cut = "" if name == "records" else ", part int"
        rows = self.spark.read.schema(schema + cut).option("basePath", f"{self.path}/{name}").parquet(*[f"{self.path}/{name}/commit={c.folder}" for c in commits])
        if parts is not None and len(parts) < commits[0].parts:
            rows = rows.where(F.col("part").isin(parts))
        return rows.select(*[f.split()[0] for f in schema.split(", ")])

    def records(self) -> DataFrame:
        return self.read("records")

    @staticmethod
    def _part(key: Column, parts: int) -> Column:
        return F.pmod(key, F.lit(parts)).cast("int")

    def _touched(self, keys: DataFrame, key: Column, commits: list[Commit]) -> list[int]:
        """The parts that ``keys`` fall in: no more numbers than there are parts."""
        if not commits:
            return []
        return sorted(r[0] for r in keys.select(self._part(key, commits[0].parts).alias("p")).distinct().collect())

    def _plan(self, batches: DataFrame) -> tuple[Commit | None, list[Commit], bool]:
        """The commit that ``batches`` make, those before it, and whether it is there already."""
        row = batches.agg(F.min("batch_no").alias("a"), F.max("batch_no").alias("z"), F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(image_id, batch_no, sha, bits))").alias("m"), F.count_if(F.col("bits").isNotNull()).alias("b")).first()
        if not row["n"]:
            return None, [], False
        there = self.commits()
        wanted = -(-row["b"] * (self.k + 1) // PART_ROWS)
        parts = there[0].parts if there else max(LEAST_PARTS, min(MOST_PARTS, 1 << (wanted - 1).bit_length() if wanted > 1 else 1))
        mine = Commit(row["a"], row["z"], row["n"], row["m"], parts, self.k)
        if later := [c for c in there if c.last >= mine.first and c != mine]:
            if not (mine in there and all(c.first > mine.last for c in later)):
                raise ValueError(f"batches up to {max(c.last for c in later)} are in the history already, with other rows or other bounds than {mine.first} to {mine.last}")
        return mine, [c for c in there if c.last < mine.first], mine in there

    def _write(self, accepted: DataFrame, commit: Commit) -> None:
        """The tables of ``accepted`` (image_id, batch_no, sha, bits), each in place of what a failed call left, and then the marker."""
        least = F.min("image_id").alias("image_id")
        contents = accepted.where("sha is not null").groupBy("sha").agg(least)
        prints = accepted.where("bits is not null").groupBy("bits").agg(least).select(F.xxhash64("bits").alias("id"), "bits", "image_id")
        tables = {
            "records": (accepted.select("image_id", "batch_no", "sha", "bits"), None),
            "contents": (contents, F.xxhash64("sha")),
            "prints": (prints, F.col("id")),
            "blocks": (postings(_strings(accepted, False), self.k).select("key", "id"), F.col("key")),
        }

        def put(name: str) -> None:
            rows, key = tables[name]
            if key is not None:
                # Rebalanced by part: small parts share a task, a part of a hot key is split.
                rows = rows.withColumn("part", self._part(key, commit.parts)).hint("rebalance", "part")
            rows.write.mode("overwrite").partitionBy(*([] if key is None else ["part"])).parquet(f"{self.path}/{name}/commit={commit.folder}")

        with shuffle_files_end_with_the_plan(self.spark), ThreadPoolExecutor(len(tables)) as pool:
            list(pool.map(put, tables))
        _Files(self.spark, self.path).put(f"{self.path}/commits/{commit.folder}.json", json.dumps(asdict(commit)))

    def accept(self, batches: DataFrame) -> None:
        """Take ``batches`` (image_id, batch_no, sha, bits) in whole, without looking for repetitions."""
        commit, _, done = self._plan(batches)
        if commit is not None and not done:
            self._write(batches, commit)

    def admit(self, batches: DataFrame, scratch: Scratch) -> DataFrame:
        """(earlier_id, image_id) of the records of ``batches`` that repeat an accepted one; the others are appended.

        ``batches`` is a stored table of (image_id, batch_no, sha, bits), each
        image_id once.  Records of one batch aren't compared with each other.
        earlier_id is the smallest accepted image_id of an earlier batch with
        the same sha or near bits.  Null sha and null bits match nothing.
        Batches come in the order of their numbers: ValueError where later ones
        than these are in the history, or these with other rows.
        """
        commit, before, done = self._plan(batches)
        if commit is None:
            return self.spark.createDataFrame([], "earlier_id long, image_id long")
        known, links = self._near(before, batches, scratch)
        first = scratch.save(self._against_history(before, batches, known, links), "against-history")
        decided = scratch.save(self._replay(first, links, scratch), "decided")
        if not done:
            self._write(decided.where("earlier_id is null").join(batches.select("image_id", "sha", "bits"), "image_id").select("image_id", "batch_no", "sha", "bits"), commit)
        return decided.where("earlier_id is not null").select("earlier_id", "image_id")

    def _near(self, before: list[Commit], new: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
        """The fingerprints of the history (id, bits, image_id) that share a block with a new one, and
        (bits, near): both directions of each near pair of different fingerprints with a new one in it."""
        inner = Scratch(self.spark, "lookup")
        fresh = inner.save(_strings(new, True), "fresh")
        posts = postings(fresh, self.k)
        blocks = self.read("blocks", before, self._touched(posts, F.col("key"), before))
        hits = inner.save(blocks.join(posts.select("key").distinct(), "key", "left_semi").select("key", "id", F.lit(False).alias("fresh")), "hits")
        ids = hits.select("id").distinct()
        known = self.read("prints", before, self._touched(ids, F.col("id"), before)).join(ids, "id", "left_semi")
        known = scratch.save(known.groupBy("id", "bits").agg(F.min("image_id").alias("image_id")), "known")
        # Under hot keys the strings themselves are looked at; those that are new as well stay fresh there.
        old = known.select("id", "bits", F.hex("bits").alias("hex"), F.lit(False).alias("fresh"))
        every = fresh.unionByName(old.join(fresh.select("id"), "id", "left_anti"))
        pairs = candidate_pairs(every, self.k, inner, posts=posts.unionByName(hits))
        near = verified(pairs, known.select("id", "bits").unionByName(fresh.select("id", "bits")), self.k, inner)
        both = near.select(F.explode(F.array(F.struct(F.col("bits_a").alias("bits"), F.col("bits_b").alias("near")), F.struct(F.col("bits_b").alias("bits"), F.col("bits_a").alias("near")))).alias("e"))
        links = scratch.save(both.select("e.*"), "near")
        inner.close()
        return known, links

    @staticmethod
    def _spread(least: DataFrame, links: DataFrame, value: str) -> DataFrame:
        """(bits, value): the least value of a fingerprint itself and of those near to it."""
        around = links.join(least.withColumnRenamed("bits", "near"), "near").select("bits", value)
        return least.select("bits", value).unionByName(around).groupBy("bits").agg(F.min(value).alias(value))

    def _against_history(self, before: list[Commit], new: DataFrame, known: DataFrame, links: DataFrame) -> DataFrame:
        """The new records with ``old_id``, the smallest accepted image_id that they repeat, or null."""
        held = new.where("sha is not null").select("sha").distinct()
        contents = self.read("contents", before, self._touched(held, F.xxhash64("sha"), before))
        by_sha = contents.join(held, "sha", "left_semi").groupBy("sha").agg(F.min("image_id").alias("s_id"))
        by_bits = self._spread(known.groupBy("bits").agg(F.min("image_id").alias("b_id")), links, "b_id")
        return new.join(by_sha, "sha", "left").join(by_bits, "bits", "left").select("image_id", "batch_no", "sha", "bits", F.least("s_id", "b_id").alias("old_id"))

    def _replay(self, first: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
        """(image_id, batch_no, earlier_id) of every new record, accepted batch after batch.

        Only records that may repeat a record of an earlier pending batch take
        part in the loop; they and what they may repeat are few.
        """
        able = first.where("old_id is null")
        sha_from = able.where("sha is not null").groupBy("sha").agg(F.min("batch_no").alias("s_from"))
        bits_from = able.where("bits is not null").groupBy("bits").agg(F.min("batch_no").alias("batch_no"))
        bits_from = self._spread(bits_from, links, "batch_no").withColumnRenamed("batch_no", "b_from")
        waits = F.coalesce(F.least("s_from", "b_from") < F.col("batch_no"), F.lit(False))
        marked = first.join(sha_from, "sha", "left").join(bits_from, "bits", "left").select("image_id", "batch_no", "sha", "bits", "old_id", waits.alias("waits"))
        marked = scratch.save(marked, "marked")
        waiting = scratch.save(marked.where("waits").drop("waits"), "waiting")
        reached = waiting.select("bits").unionByName(waiting.join(links, "bits").select(F.col("near").alias("bits"))).distinct()
        giving = marked.where("old_id is null")
        givers = giving.join(waiting.select("sha").distinct(), "sha", "left_semi").unionByName(giving.join(reached, "bits", "left_semi")).distinct()
        accepted = scratch.save(givers.where("not waits").select("image_id", "batch_no", "sha", "bits"), "accepted")
        close = links.join(waiting.select("bits").distinct(), "bits", "left_semi")
        close = scratch.save(close, "close")
        decided = [marked.where("not waits").select("image_id", "batch_no", F.col("old_id").alias("earlier_id"))]
        for batch in sorted(r.batch_no for r in waiting.select("batch_no").distinct().collect()):
            before, now = accepted.where(F.col("batch_no") < batch), waiting.where(F.col("batch_no") == batch)
            by_sha = before.where("sha is not null").groupBy("sha").agg(F.min("image_id").alias("s_id"))
            by_bits = before.where("bits is not null").groupBy("bits").agg(F.min("image_id").alias("image_id"))
            by_bits = self._spread(by_bits, close, "image_id").withColumnRenamed("image_id", "b_id")
            done = now.join(by_sha, "sha", "left").join(by_bits, "bits", "left").select("image_id", "batch_no", "sha", "bits", F.least("old_id", "s_id", "b_id").alias("earlier_id"))
            done = scratch.save(done, "decided")
            decided.append(done.select("image_id", "batch_no", "earlier_id"))
            accepted = accepted.unionByName(done.where("earlier_id is null").select("image_id", "batch_no", "sha", "bits"))
        out = decided[0]
        for more in decided[1:]:
            out = out.unionByName(more)
        return out


def repeated_photos(images: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(earlier_id, image_id) of every record that repeats an accepted record of an earlier delivery.

    The first delivery is accepted whole and becomes the history; the later
    ones are admitted against it.  A record delivered again counts once, in its
    first delivery; a record without a delivery number comes last; null sha256
    and unusable dhash values match nothing; an empty table gives no rows.
    """
    spark = images.sparkSession
    scratch = Scratch(spark, "increments")
    records = scratch.save(photo_records(images), "records")
    first = records.agg(F.min("batch_no")).first()[0]
    if first is None:
        return spark.createDataFrame([], "earlier_id long, image_id long")
    history = History(spark, f"{scratch.root}/history", max_distance)
    history.accept(records.where(F.col("batch_no") == first))
    return history.admit(records.where(F.col("batch_no") > first), scratch)
