"""The named queries of the engine's own operators, each over whole tables, and the SQL that checks them.

Numbers are rounded on both sides, as sums are taken in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.config import Config, Consensus
from peerlens.functions import text
from peerlens.functions.hashing import content_hash
from peerlens.functions.vectors import length, unit
from peerlens.operators import calibrate, consensus, decide, documents, duplicates, explain, geometry, harness, profile, ranking, records
from peerlens.operators.scratch import Scratch
from peerlens.plans import fragments as q
from peerlens.sources.cache import missing
from peerlens.sources.images import items_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
CFG = Config()


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return rows.select(F.col("label").cast("string").alias("grp"), F.col("vec_id").alias("item"), F.col("embedding").cast("array<double>").alias("vec"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(_table(spark, sf_dir, "images"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "image_vectors").where("model = 'dinov2' and size(vec) = 64")
    return rows.select(F.lower(F.regexp_replace("sha256", r"^\s+|\s+$", "")).alias("sha"), "vec")


def _scores(items: DataFrame) -> DataFrame:
    return consensus.modified_z(consensus.consensus(items))


def _stored_scores(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame, Scratch]:
    scratch = Scratch(spark, name)
    items = _embeddings(spark, sf_dir)
    return items, decide.scores_of(items, CFG, scratch), scratch


def _r(name: str, digits: int = 5):
    return F.round(name, digits).alias(name)


# Profile of a dataset


@_query("SELECT count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_items, min(n) AS min_size, median(n) AS median_size, max(n) AS max_size, count(*) FILTER (WHERE n <= 2) AS n_small FROM (SELECT outlet, count(*) AS n FROM images WHERE outlet IS NOT NULL GROUP BY outlet)")
def profile_groups(spark, sf_dir):
    return profile.group_sizes(_images(spark, sf_dir))


@_query("SELECT CAST(floor(n / 5.0) * 5 AS BIGINT) AS size_from, count(*) AS n_groups FROM (SELECT outlet, count(*) AS n FROM images WHERE outlet IS NOT NULL GROUP BY outlet) GROUP BY 1")
def profile_histogram(spark, sf_dir):
    return profile.size_histogram(_images(spark, sf_dir))


@_query(r"SELECT lower(regexp_extract(file_name, '\.([A-Za-z0-9]+)$', 1)) AS value, count(*) AS times FROM images GROUP BY 1 ORDER BY times DESC, value LIMIT 5")
def profile_formats(spark, sf_dir):
    return profile.top_values(_table(spark, sf_dir, "images").select(text.extension(F.col("file_name")).alias("x")), "x")


@_query("WITH RECURSIVE " + ",\n".join([q.IMAGES, q.COPIES]) + """
, sets AS (SELECT c.grp, c.root, count(*) AS n, count(DISTINCT coalesce(p.sha, p.item)) AS d FROM copies c JOIN pics p ON p.grp = c.grp AND p.item = c.item WHERE c.size > 1 GROUP BY c.grp, c.root)
SELECT CAST((SELECT coalesce(sum(n - d), 0) FROM sets) AS BIGINT) AS exact, CAST((SELECT coalesce(sum(d - 1), 0) FROM sets) AS BIGINT) AS near,
  (SELECT count(*) FROM (SELECT sha FROM pics WHERE sha IS NOT NULL GROUP BY sha HAVING count(DISTINCT grp) > 1)) AS "cross", (SELECT count(*) FROM pics WHERE NOT readable) AS unreadable""")
def profile_copies(spark, sf_dir):
    scratch = Scratch(spark, "profile")
    items = scratch.save(_one_row_each(_images(spark, sf_dir)), "items")
    return profile.copy_counts(items, duplicates.copy_groups(items, CFG.dedup.near_dup_hamming, scratch))


def _one_row_each(items: DataFrame) -> DataFrame:
    one = F.max(F.struct("readable", "sha", "bits"))
    return items.where("grp is not null and item is not null").groupBy("grp", "item").agg(one.alias("r")).select("grp", "item", "r.sha", "r.readable", "r.bits")


@_query(r"SELECT image_id, path FROM images WHERE lower(regexp_extract(path, '\.([A-Za-z0-9]+)$', 1)) IN ('jpg', 'jpeg', 'png', 'webp', 'bmp')")
def image_files(spark, sf_dir):
    return _table(spark, sf_dir, "images").where(text.is_image(F.col("path"))).select("image_id", "path")


# Content and copies


@_query("SELECT doc_id, sha256(text) AS sha FROM documents WHERE text IS NOT NULL")
def content_hashes(spark, sf_dir):
    return _table(spark, sf_dir, "documents").where("text is not null").select("doc_id", content_hash(F.encode("text", "UTF-8")).alias("sha"))


@_query(f"WITH {q.IMAGES} SELECT sha, count(*) AS n_items, count(DISTINCT grp) AS n_groups, min({{'g': grp, 'i': item}}).g AS first_grp, min({{'g': grp, 'i': item}}).i AS first_item FROM pics WHERE sha IS NOT NULL GROUP BY sha")
def content_hash_index(spark, sf_dir):
    return duplicates.content_index(_one_row_each(_images(spark, sf_dir)))


@_query("WITH " + ",\n".join([q.IMAGES, q.CROSS]) + " SELECT grp, item, other.g AS other_grp, other.i AS other_item FROM crossed")
def cross_group_duplicates(spark, sf_dir):
    return duplicates.cross_group_copies(Scratch(spark, "cross-copies").save(_one_row_each(_images(spark, sf_dir)), "items"))


@_query(f"""WITH {q.IMAGES}, held AS (SELECT DISTINCT grp, bits, hex(bits::BLOB) AS h FROM pics WHERE bits IS NOT NULL)
SELECT a.grp, least(a.h, b.h) AS a, greatest(a.h, b.h) AS b FROM held a JOIN held b ON a.grp = b.grp AND a.h < b.h AND bit_count(xor(a.bits, b.bits)) <= 8""")
def near_copy_pairs(spark, sf_dir):
    scratch = Scratch(spark, "near-pairs")
    near = duplicates.near_content(_one_row_each(_images(spark, sf_dir)), CFG.dedup.near_dup_hamming, scratch)
    return near.select("grp", F.least(F.hex("bits_a"), F.hex("bits_b")).alias("a"), F.greatest(F.hex("bits_a"), F.hex("bits_b")).alias("b"))


@_query("WITH RECURSIVE " + ",\n".join([q.IMAGES, q.COPIES]) + " SELECT grp, item, root, rep, rep = item AS is_rep, CAST(size AS INTEGER) AS size FROM copies")
def copy_components(spark, sf_dir):
    scratch = Scratch(spark, "components")
    items = scratch.save(_one_row_each(_images(spark, sf_dir)), "items")
    return duplicates.copy_groups(items, CFG.dedup.near_dup_hamming, scratch)


@_query("WITH RECURSIVE " + ",\n".join([q.IMAGES, q.COPIES, q.VECTORS, q.REPS]) + " SELECT grp, item, sha, round(vec[1], 6) AS first, round(vec[64], 6) AS last FROM items")
def representatives(spark, sf_dir):
    ready = decide.prepare(_images(spark, sf_dir), _vectors(spark, sf_dir), CFG, Scratch(spark, "representatives"))
    return ready.reps.select("grp", "item", "sha", F.round(F.col("vec")[0], 6).alias("first"), F.round(F.col("vec")[63], 6).alias("last"))


@_query(r"""SELECT DISTINCT lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')) AS sha FROM images WHERE sha256 IS NOT NULL AND readable
AND lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')) NOT IN (SELECT lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')) FROM image_vectors WHERE sha256 IS NOT NULL AND model = 'dinov2' AND len(vec) = 64)""")
def cache_misses(spark, sf_dir):
    return missing(_images(spark, sf_dir).where("readable").select("sha"), _vectors(spark, sf_dir))


# Vectors and similarity


@_query("SELECT vec_id, round(sqrt(list_inner_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[]))), 4) AS length FROM image_vectors WHERE model = 'dinov2' AND len(vec) = 64 AND isfinite(list_sum(CAST(vec AS DOUBLE[])))")
def vector_lengths(spark, sf_dir):
    rows = _table(spark, sf_dir, "image_vectors").where("model = 'dinov2' and size(vec) = 64")
    return rows.where(F.forall("vec", lambda x: F.abs(x) < float("inf"))).select("vec_id", F.round(length(F.col("vec")), 4).alias("length"))


@_query(f"""WITH {q.VECTORS}, one AS (SELECT sha, vec FROM vectors) SELECT sha, round(vec[1], 5) AS a, round(vec[32], 5) AS b FROM one""")
def unit_vectors(spark, sf_dir):
    rows = _vectors(spark, sf_dir).where("sha is not null").groupBy("sha").agg(F.min(unit(F.col("vec"))).alias("vec")).where("vec is not null")
    return rows.select("sha", F.round(F.col("vec")[0], 5).alias("a"), F.round(F.col("vec")[31], 5).alias("b"))


@_query("WITH " + ",\n".join([q.EMB, q.PAIR]) + " SELECT grp, i AS item, CAST(count(*) AS INTEGER) AS n_peers, round(min(cos), 5) AS least, round(avg(cos), 5) AS mean, round(max(cos), 5) AS greatest FROM pair GROUP BY grp, i")
def pairwise_cosine(spark, sf_dir):
    return consensus.similarity_profile(_embeddings(spark, sf_dir)).select("grp", "item", "n_peers", _r("least"), _r("mean"), _r("greatest"))


@_query("WITH " + ",\n".join([q.EMB, q.PAIR, q.CONSENSUS, q.SCORES, q.DONORS, q.SAMPLES]) + " SELECT grp, item, round(s, 5) AS s FROM foreign_s")
def cross_group_cosine(spark, sf_dir):
    items, scores, scratch = _stored_scores(spark, sf_dir, "cross")
    drawn = calibrate.donors(scores.where("n_scored >= 2").select("grp").distinct(), CFG.seed)
    foreign = drawn.join(items.withColumnRenamed("grp", "donor"), "donor").select("grp", "item", "vec")
    return consensus.consensus(items, foreign).select("grp", "item", _r("s"))


@_query("WITH " + ",\n".join([q.EMB, q.PAIR, q.CONSENSUS]) + " SELECT grp, item, CAST(n_peers AS INTEGER) AS n_peers, round(s, 5) AS s FROM cons")
def consensus_median(spark, sf_dir):
    return consensus.consensus(_embeddings(spark, sf_dir)).select("grp", "item", "n_peers", _r("s"))


@_query("WITH " + ",\n".join([q.EMB, q.PAIR]) + """
, r AS (SELECT grp, i, cos, row_number() OVER (PARTITION BY grp, i ORDER BY cos) - 1 AS k, count(*) OVER (PARTITION BY grp, i) AS n FROM pair)
SELECT grp, i AS item, CAST(any_value(n) AS INTEGER) AS n_peers, round(avg(cos), 5) AS s FROM r WHERE k >= floor(0.2 * n) AND k < n - floor(0.2 * n) GROUP BY grp, i""")
def consensus_trimmed_mean(spark, sf_dir):
    return consensus.consensus(_embeddings(spark, sf_dir), how=Consensus(method="trimmed_mean")).select("grp", "item", "n_peers", _r("s"))


@_query("WITH " + ",\n".join([q.EMB, q.SCORED]) + " SELECT grp, item, round(s, 5) AS s, round(median_s, 5) AS median_s, round(mad, 5) AS mad, round(z, 4) AS z, CAST(n_scored AS INTEGER) AS n_scored FROM scores")
def modified_zscore(spark, sf_dir):
    return _scores(_embeddings(spark, sf_dir)).select("grp", "item", _r("s"), _r("median_s"), _r("mad"), _r("z", 4), "n_scored")


@_query("WITH " + ",\n".join([q.EMB, q.SCORED]) + " SELECT grp, CAST(max(n_scored) AS INTEGER) AS n_scored, round(max(median_s), 5) AS median_s, coalesce(max(n_scored) >= 3 AND max(median_s) < 0.45, false) AS review FROM scores GROUP BY grp")
def folder_review(spark, sf_dir):
    return consensus.folders(_scores(_embeddings(spark, sf_dir))).select("grp", "n_scored", _r("median_s"), "review")


@_query(q.IMAGE_SCORES + " SELECT grp, item, CAST(n_peers AS INTEGER) AS n_peers, round(s, 5) AS s, round(z, 4) AS z, CAST(n_scored AS INTEGER) AS n_scored FROM scores")
def image_consensus(spark, sf_dir):
    ready = decide.prepare(_images(spark, sf_dir), _vectors(spark, sf_dir), CFG, Scratch(spark, "image-consensus"))
    return ready.scores.select("grp", "item", "n_peers", _r("s"), _r("z", 4), "n_scored")


@_query("WITH " + ",\n".join([q.EMB, q.SCORED]) + " SELECT grp, item, round(s, 5) AS s, CAST(row_number() OVER (PARTITION BY grp ORDER BY s, item) AS INTEGER) AS rank FROM scores")
def ranked_outliers(spark, sf_dir):
    scores = _scores(_embeddings(spark, sf_dir))
    return ranking.ranked(scores.select("grp", "item", "s"), "grp", [F.col("s").asc_nulls_last(), F.col("item").asc()]).select("grp", "item", _r("s"), "rank")


@_query("WITH " + ",\n".join([q.EMB, q.PAIR]) + " SELECT grp, i AS item, CAST(r AS INTEGER) AS rank, j AS peer, round(cos, 5) AS cos FROM (SELECT *, row_number() OVER (PARTITION BY grp, i ORDER BY cos DESC, j) AS r FROM pair) WHERE r <= 3")
def top_peers(spark, sf_dir):
    return consensus.top_peers(_embeddings(spark, sf_dir), 3).select("grp", "item", "rank", "peer", _r("cos"))


@_query("WITH " + ",\n".join([q.EMB, q.SCORED]) + """
, sim AS (SELECT p.grp, p.i, p.j, row_number() OVER (PARTITION BY p.grp, p.i ORDER BY p.cos DESC, p.j) AS r FROM pair p),
typ AS (SELECT a.grp, a.item AS i, b.item AS j, 3 + row_number() OVER (PARTITION BY a.grp, a.item ORDER BY b.s DESC, b.item) AS r FROM scores a JOIN scores b ON a.grp = b.grp AND a.item <> b.item)
SELECT grp, i AS item, j AS peer, CAST(min(r) AS INTEGER) AS pos FROM (SELECT * FROM sim WHERE r <= 3 UNION ALL SELECT * FROM typ WHERE r <= 5) GROUP BY grp, i, j""")
def typical_peers(spark, sf_dir):
    items, scores, _ = _stored_scores(spark, sf_dir, "typical")
    return consensus.peers_to_verify(items, items, scores, 3, 2).select("grp", "item", "peer", F.col("pos").cast("int").alias("pos"))


@_query("WITH " + ",\n".join([q.EMB, q.SCORED]) + """
SELECT p.grp, p.i AS item, CAST(count(*) + 1 AS INTEGER) AS size, round(median(p.cos), 5) AS s_sub, bool_or(coalesce(o.s >= 0.15, false)) AS anchored
FROM pair p JOIN scores o ON o.grp = p.grp AND o.item = p.j WHERE p.cos >= 0.15 GROUP BY p.grp, p.i HAVING count(*) + 1 >= 3""")
def support_group(spark, sf_dir):
    items, scores, _ = _stored_scores(spark, sf_dir, "support")
    found = consensus.support_groups(items, items.join(scores.select("grp", "item", "s"), ["grp", "item"]), 0.15, 3)
    return found.select("grp", "item", F.col("size").cast("int").alias("size"), _r("s_sub"), "anchored")


# Calibration


@_query("WITH " + ",\n".join([q.EMB, q.CALIBRATED]) + " SELECT m.side, count(*) AS n, round(quantile_cont(x, 0.05), 5) AS q05, round(quantile_cont(x, 0.25), 5) AS q25, round(quantile_cont(x, 0.5), 5) AS q50, round(quantile_cont(x, 0.75), 5) AS q75, round(quantile_cont(x, 0.95), 5) AS q95, round(any_value(d.bw), 6) AS bandwidth FROM sample m JOIN side d ON d.side = m.side GROUP BY m.side")
def lr_samples(spark, sf_dir):
    items, scores, scratch = _stored_scores(spark, sf_dir, "samples")
    drawn = decide.samples(items, scores, CFG)
    drawn = scratch.save(drawn, "samples")
    spread = drawn.groupBy("side").agg((F.stddev_samp("x") * F.pow(F.count("x"), F.lit(-0.2))).alias("bw"))
    rows = ranking.quantiles(drawn, "side", "x", [0.05, 0.25, 0.5, 0.75, 0.95], scratch).join(spread, "side")
    return rows.select("side", F.col("n").cast("bigint").alias("n"), *[F.round(F.col("q")[i], 5).alias(n) for i, n in enumerate(("q05", "q25", "q50", "q75", "q95"))], F.round("bw", 6).alias("bandwidth"))


@_query("WITH " + ",\n".join([q.EMB, q.PAIR]) + "".join(
    (", within AS (SELECT cos FROM pair WHERE i < j) " if i == 0 else " UNION ALL ") + f"SELECT CAST({p} AS DOUBLE) AS at, round(quantile_cont(cos, {p}), 5) AS value FROM within" for i, p in enumerate((0.05, 0.25, 0.5, 0.75, 0.95))
))
def pair_quantiles(spark, sf_dir):
    found = consensus.pair_quantiles(_embeddings(spark, sf_dir), [0.05, 0.25, 0.5, 0.75, 0.95])
    return spark.createDataFrame(sorted(found.items()), "at double, value double").select("at", _r("value"))


@_query("WITH " + ",\n".join([q.EMB, q.SCORED, q.DONORS]) + ", apart AS (SELECT list_inner_product(i.vec, o.vec) AS cos FROM items i JOIN donor d ON d.grp = i.grp JOIN items o ON o.grp = d.donor) " + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS at, round(quantile_cont(cos, {p}), 5) AS value FROM apart" for p in (0.05, 0.25, 0.5, 0.75, 0.95)
))
def cross_pair_quantiles(spark, sf_dir):
    """Of the similarities of all items to those of the group that theirs is held against."""
    items, scores, _ = _stored_scores(spark, sf_dir, "cross-pairs")
    asking, foreign = decide.foreign_peers(items, scores, CFG)
    found = consensus.pair_quantiles(asking, list(documents.AT), foreign)
    return spark.createDataFrame(sorted(found.items()), "at double, value double").select("at", _r("value"))


def _ratio(spark: SparkSession, sf_dir: str, name: str):
    items, scores, scratch = _stored_scores(spark, sf_dir, name)
    return items, scores, scratch, calibrate.fit(decide.samples(items, scores, CFG), CFG.gate.prior_outlier_rate)


@_query("WITH " + ",\n".join([q.EMB, q.CALIBRATED, q.density("scores", "lr", "s")]) + " SELECT s.grp, s.item, round(l.log_lr, 4) AS log_lr, round(l.p, 5) AS p FROM scores s JOIN lr l ON l.x = s.s")
def kde_posterior(spark, sf_dir):
    _, scores, _, ratio = _ratio(spark, sf_dir, "posterior")
    rows = calibrate.with_log_lr(calibrate.with_posterior(scores, ratio, "s", "p"), ratio, "s", "log_lr")
    return rows.select("grp", "item", _r("log_lr", 4), _r("p"))


@_query("WITH " + ",\n".join([q.EMB, q.CALIBRATED, q.GRID, q.density("grid", "grid_lr"), q.floors()]) + " SELECT round(floor, 5) AS floor, round(support_floor, 5) AS support_floor, round(lo, 5) AS lo, round(hi, 5) AS hi FROM floors, span")
def solve_floors(spark, sf_dir):
    *_, ratio = _ratio(spark, sf_dir, "floors")
    rows = [(ratio.floor(CFG.gate.p_thresh), ratio.support_floor, ratio.lo, ratio.hi)]
    return spark.createDataFrame(rows, "floor double, support_floor double, lo double, hi double").select(_r("floor"), _r("support_floor"), _r("lo"), _r("hi"))


# Decisions


@_query("WITH " + ",\n".join([q.EMB, q.CALIBRATED, q.GATED]) + " SELECT grp, item, round(z, 4) AS z, round(p0, 5) AS p, candidate, coalesce(z < -2.5 AND p0 >= 0.05, false) AS dual FROM cand")
def candidates(spark, sf_dir):
    _, scores, _, ratio = _ratio(spark, sf_dir, "candidates")
    rows = calibrate.with_posterior(scores, ratio, "s", "p")
    chosen = consensus.candidate(F.col("n_scored"), F.col("z"), F.col("p"), CFG.gate)
    return rows.select("grp", "item", _r("z", 4), _r("p"), chosen.alias("candidate"), consensus.dual_gate(F.col("z"), F.col("p"), 2.5, 0.05).alias("dual"))


@_query("WITH RECURSIVE " + ",\n".join([q.IMAGES, q.COPIES, q.VECTORS, q.REPS, q.CALIBRATED, q.GATED]) + " SELECT grp, item, candidate, CAST(sub_size AS INTEGER) AS sub_size, round(sub_s, 5) AS sub_s, sub_anchored, round(p, 5) AS p, flagged, kind FROM flags")
def subgroup_discount(spark, sf_dir):
    scratch = Scratch(spark, "subgroup")
    ready = decide.prepare(_images(spark, sf_dir), _vectors(spark, sf_dir), CFG, scratch)
    ratio = calibrate.fit(decide.samples(ready.reps, ready.scores, CFG), CFG.gate.prior_outlier_rate)
    gated = decide.gate(ready.reps, ready.scores, ratio, CFG, scratch)
    return gated.select("grp", "item", "candidate", F.col("sub_size").cast("int").alias("sub_size"), _r("sub_s"), "sub_anchored", _r("p"), "flagged", "kind")


def _audited(spark: SparkSession, sf_dir: str, name: str):
    scratch = Scratch(spark, name)
    decided, ready, ratio = decide.audit(_images(spark, sf_dir), _vectors(spark, sf_dir), CFG, scratch)
    return decided, ready, ratio, scratch


@_query(q.AUDIT + " SELECT grp, item, kind, round(suspicion, 5) AS suspicion, flagged, dup_of, rep_flagged, other_grp, other_item, CAST(rank AS INTEGER) AS rank FROM ranked")
def decisions(spark, sf_dir):
    decided, *_ = _audited(spark, sf_dir, "decisions")
    return decided.select("grp", "item", "kind", _r("suspicion"), "flagged", "dup_of", "rep_flagged", "other_grp", "other_item", "rank")


# The sentences of a reason, as in explain.py.
_REASON = """CASE WHEN kind = 'unreadable' THEN 'File could not be decoded as an image.'
  WHEN kind = 'cross_duplicate' THEN 'Identical file (content hash match) also submitted under ' || other_grp || '/' || other_item || '; the same photo cannot document two outlets.'
  WHEN kind = 'duplicate' THEN 'Identical copy of ' || dup_of || ' (content hash match); duplicate submission adds no new evidence of a visit.' || CASE WHEN rep_flagged THEN ' The original copy is itself flagged.' ELSE '' END END"""


@_query(q.AUDIT + f" SELECT grp, item, {_REASON} AS reason FROM ranked WHERE flagged AND kind IN ('unreadable', 'cross_duplicate', 'duplicate')")
def reasons(spark, sf_dir):
    decided, _, ratio, _ = _audited(spark, sf_dir, "reasons")
    rows = decided.withColumn("reason", explain.reason(ratio.floor(CFG.gate.p_thresh), ratio.support_floor))
    return rows.where("flagged and kind in ('unreadable', 'cross_duplicate', 'duplicate')").select("grp", "item", "reason")


_NUMBERS = """CASE WHEN kind = 'pair' THEN 'Only 2 usable images and they do not match each other (similarity ' || format('{:.2f}', s) || ' < absolute floor ' || format('{:.2f}', floor) || '); cannot determine which one is genuine, review both.'
  ELSE 'Median similarity to peers ' || format('{:.2f}', s) || ' vs folder median ' || format('{:.2f}', median_s) || ' (modified z = ' || format('{:.1f}', z) || '; absolute floor ' || format('{:.2f}', floor) || ').'
    || CASE WHEN sub_anchored THEN ' Note: ' || (sub_size - 1) || ' other images in this folder resemble it (median similarity ' || format('{:.2f}', sub_s) || ' > support level ' || format('{:.2f}', support_floor) || '), but not enough to clear the gate.'
      WHEN NOT sub_anchored THEN ' ' || (sub_size - 1) || ' other images in this folder resemble it (median similarity ' || format('{:.2f}', sub_s) || ') but none of them matches the rest of the folder either: a coherent group that is foreign as a whole.' ELSE '' END END"""


@_query(q.AUDIT + f" SELECT grp, item, kind, coalesce({_REASON}, {_NUMBERS}) AS reason FROM ranked, floors WHERE flagged")
def flagged_reasons(spark, sf_dir):
    """The reason of every flagged item, of the kinds scored and pair too."""
    decided, _, ratio, _ = _audited(spark, sf_dir, "flagged-reasons")
    rows = decided.withColumn("reason", explain.reason(ratio.floor(CFG.gate.p_thresh), ratio.support_floor))
    return rows.where("flagged").select("grp", "item", "kind", "reason")


@_query(q.AUDIT + f" SELECT grp, item, {_NUMBERS} AS reason FROM ranked, floors WHERE kind IN ('scored', 'pair') AND s IS NOT NULL")
def content_reasons(spark, sf_dir):
    """What the evidence says of every scored item, flagged or not: statistic and subgroup, or that it is one of a pair."""
    decided, _, ratio, _ = _audited(spark, sf_dir, "content-reasons")
    rows = decided.where("kind in ('scored', 'pair') and s is not null")
    return rows.select("grp", "item", explain.reason(ratio.floor(CFG.gate.p_thresh), ratio.support_floor).alias("reason"))


@_query(q.AUDIT + """ SELECT r.grp AS outlet_id, 0 AS piece, CAST(count(*) AS INTEGER) AS total_images, CAST(count(*) FILTER (WHERE flagged) AS INTEGER) AS n_flagged,
  coalesce(string_agg(item, '|' ORDER BY rank) FILTER (WHERE flagged), '') AS flagged_images, string_agg(item, '|' ORDER BY rank) AS ranking,
  round(max(m.median_s), 3) AS folder_median_consensus, coalesce(max(m.n_scored) >= 3 AND max(m.median_s) < 0.45, false) AS review_folder
FROM ranked r LEFT JOIN med m ON m.grp = r.grp GROUP BY r.grp""")
def outlet_records(spark, sf_dir):
    decided, ready, *_ = _explained(spark, sf_dir, "records")
    rows = records.group_records(decided, consensus.folders(ready.scores, CFG.gate))
    return rows.select(
        "outlet_id", "piece", "total_images", F.size("flagged_images").alias("n_flagged"), F.array_join(F.transform("flagged_images", lambda x: x["file_name"]), "|").alias("flagged_images"),
        F.array_join("ranking", "|").alias("ranking"), "folder_median_consensus", "review_folder",
    )


def _explained(spark: SparkSession, sf_dir: str, name: str):
    decided, ready, ratio, scratch = _audited(spark, sf_dir, name)
    decided = decided.withColumn("reason", F.when(F.col("flagged"), explain.reason(ratio.floor(CFG.gate.p_thresh), ratio.support_floor)))
    return decided, ready, ratio, scratch


_NAN = "CASE WHEN {0} IS NULL THEN 'nan' ELSE format('{{:.{1}f}}', {0}) END"


@_query(q.AUDIT + f""" SELECT grp AS outlet_id, item AS file_name, CAST(rank AS INTEGER) AS rank, {_NAN.format('suspicion', 4)} AS suspicion_score, CAST(flagged AS INTEGER) AS flagged, kind,
  {_NAN.format('s', 3)} AS consensus, {_NAN.format('z', 2)} AS z, CASE WHEN flagged THEN coalesce({_REASON}, {_NUMBERS}) ELSE '' END AS reason FROM ranked, floors""")
def image_rows(spark, sf_dir):
    return records.item_rows(_explained(spark, sf_dir, "rows")[0])


@_query(q.AUDIT + f""", told AS (SELECT grp, item, rank, flagged, round(suspicion, 4) AS score, coalesce({_REASON}, {_NUMBERS}) AS reason FROM ranked, floors)
SELECT t.grp AS outlet_id, 0 AS piece, CAST(count(*) AS INTEGER) AS total_images, CAST(count(*) FILTER (WHERE flagged) AS INTEGER) AS n_flagged,
  coalesce(CAST(to_json(list({{'file_name': item, 'suspicion_score': score, 'reason': reason}} ORDER BY rank) FILTER (WHERE flagged)) AS VARCHAR), '[]') AS flagged_images,
  CAST(to_json(list(item ORDER BY rank)) AS VARCHAR) AS ranking, coalesce(CAST(round(max(m.median_s), 3) AS VARCHAR), '') AS folder_median_consensus,
  CAST(coalesce(max(m.n_scored) >= 3 AND max(m.median_s) < 0.45, false) AS INTEGER) AS review_folder
FROM told t LEFT JOIN med m ON m.grp = t.grp GROUP BY t.grp""")
def csv_records(spark, sf_dir):
    decided, ready, *_ = _explained(spark, sf_dir, "csv")
    return records.csv_records(records.group_records(decided, consensus.folders(ready.scores, CFG.gate)))


_AT = (0.05, 0.25, 0.5, 0.75, 0.95)


def _each(name: str, value: str, rows: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}.{p}' AS name, round(quantile_cont({value}, {p}), 3) AS value FROM {rows}" for p in _AT)


@_query(q.AUDIT + ", apart AS (SELECT list_inner_product(i.vec, o.vec) AS cos FROM items i JOIN donor d ON d.grp = i.grp JOIN items o ON o.grp = d.donor) " + " UNION ALL ".join([
    "SELECT 'n_legit' AS name, CAST(count(*) AS DOUBLE) AS value FROM sample WHERE side = 'pos'", "SELECT 'n_foreign', count(*) FROM sample WHERE side = 'neg'",
    "SELECT 'floor', round(floor, 5) FROM floors", "SELECT 'support_floor', round(support_floor, 5) FROM floors", "SELECT 'p_thresh', 0.3",
    _each("legit_consensus_quantiles", "x", "sample WHERE side = 'pos'"), _each("foreign_consensus_quantiles", "x", "sample WHERE side = 'neg'"),
    _each("within_pair_quantiles", "cos", "pair WHERE i < j"), _each("cross_pair_quantiles", "cos", "apart"),
    "SELECT 'flag_summary.n_flagged', count(*) FROM ranked WHERE flagged", "SELECT 'flag_summary.n_outlets_with_flags', count(DISTINCT grp) FROM ranked WHERE flagged",
    "SELECT 'flag_summary.by_kind.' || kind, count(*) FROM ranked WHERE flagged GROUP BY kind",
]))
def calibration_document(spark, sf_dir):
    """The numbers of the calibration document of an audit of the images, one a row."""
    decided, ready, ratio, scratch = _audited(spark, sf_dir, "calibration")
    found = documents.calibration(ready, ratio, CFG, scratch) | {"flag_summary": documents.flags(decided)}
    rows: list[tuple[str, float]] = []

    def flat(prefix: str, part: dict) -> None:
        for key, value in part.items():
            if isinstance(value, dict):
                flat(f"{prefix}{key}.", value)
            elif not isinstance(value, str):
                rows.append((prefix + key, round(float(value), 5)))

    flat("", found)
    return spark.createDataFrame(rows, "name string, value double")


@_query(q.AUDIT + " SELECT coalesce(kind, 'all') AS kind, count(*) AS n_flagged, count(DISTINCT grp) AS n_groups FROM ranked WHERE flagged GROUP BY GROUPING SETS ((kind), ())")
def flag_summary(spark, sf_dir):
    decided, *_ = _audited(spark, sf_dir, "summary")
    return records.flag_summary(decided)


# Words and labels


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document as recognised text; the confidence falls with the line number."""
    rows = _table(spark, sf_dir, "documents").where("text is not null")
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("text"), (F.lit(1.0) / (i + 1)).alias("conf")))
    return rows.select(F.col("outlet").alias("grp"), F.col("doc_id").alias("item"), lines.alias("texts"))


@_query("WITH d AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL), s AS (SELECT doc_id, array_to_string(string_split(text, chr(10))[1:3], ' | ') AS t FROM d) SELECT doc_id AS item, CASE WHEN length(t) > 60 THEN substring(t, 1, 59) || '…' ELSE t END AS snippet FROM s")
def text_snippets(spark, sf_dir):
    return _texts(spark, sf_dir).select("item", text.snippet(F.col("texts")).alias("snippet"))


_TOKENS = r"""d AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[\s\x0b[:punct:]।॥]+')) AS t FROM d)"""


@_query("WITH " + _TOKENS + " SELECT d.doc_id AS item, CAST(count(DISTINCT t) FILTER (WHERE length(t) >= 2) AS INTEGER) AS n_tokens FROM d LEFT JOIN w ON w.doc_id = d.doc_id GROUP BY d.doc_id")
def text_tokens(spark, sf_dir):
    """Of all lines of every document, whatever their confidence."""
    return _texts(spark, sf_dir).select("item", F.size(text.tokens(F.col("texts"), 0.0)).alias("n_tokens"))


@_query("""WITH d AS (SELECT outlet AS grp, doc_id AS item, CAST(n_chars AS DOUBLE) AS s FROM documents WHERE text IS NOT NULL AND outlet IS NOT NULL AND n_chars IS NOT NULL),
lead AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY s DESC, item) AS r FROM d),
near AS (SELECT a.grp, a.item, b.item AS peer, row_number() OVER (PARTITION BY a.grp, a.item ORDER BY b.r) AS r FROM d a JOIN lead b ON a.grp = b.grp AND a.item <> b.item AND b.r <= 6)
SELECT grp, item, string_agg(CAST(peer AS VARCHAR), ',' ORDER BY r) AS peers FROM near WHERE r <= 5 GROUP BY grp, item""")
def ocr_peers(spark, sf_dir):
    """The five most typical other items of each group whose text stands beside an item's; here the longest documents are the most typical."""
    rows = _table(spark, sf_dir, "documents").where("text is not null and outlet is not null and n_chars is not null")
    rows = rows.select(F.col("outlet").alias("grp"), F.col("doc_id").alias("item"), F.col("n_chars").cast("double").alias("s"))
    named = rows.select("grp", "item", F.array(F.struct(F.col("item").cast("string").alias("text"), F.lit(1.0).alias("conf"))).alias("texts"))
    found = explain.peer_text(rows, named, CFG.ocr.peers)
    return found.select("grp", "item", F.array_join(F.transform("texts", lambda x: x["text"]), ",").alias("peers"))


@_query("""WITH d AS (SELECT outlet AS grp, doc_id AS item, coalesce(source, 'none') AS label FROM documents WHERE outlet IS NOT NULL),
c AS (SELECT a.grp, a.item, b.label, count(*) AS k FROM d a JOIN d b ON a.grp = b.grp AND a.item <> b.item GROUP BY a.grp, a.item, b.label)
SELECT grp, item, label, k, CAST(n AS BIGINT) AS n FROM (SELECT *, sum(k) OVER (PARTITION BY grp, item) AS n, row_number() OVER (PARTITION BY grp, item ORDER BY k DESC, label) AS r FROM c) WHERE r = 1""")
def majority_label(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").where("outlet is not null").select(F.col("outlet").alias("grp"), F.col("doc_id").alias("item"), F.coalesce("source", F.lit("none")).alias("label"))
    return explain.majority_of_others(rows)


@_query("""WITH prompt AS (SELECT 'label ' || label AS name, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS v FROM embeddings GROUP BY label),
s AS (SELECT e.vec_id, p.name, 10.0 * list_inner_product(CAST(e.embedding AS DOUBLE[]), p.v) AS x FROM embeddings e, prompt p),
m AS (SELECT vec_id, max(x) AS top, arg_max(name, x) AS label FROM s GROUP BY vec_id)
SELECT m.vec_id, m.label, round(1 / sum(exp(s.x - m.top)), 5) AS p FROM m JOIN s ON s.vec_id = m.vec_id GROUP BY m.vec_id, m.label""")
def zero_shot_softmax(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    prompts = [("label " + str(r["label"]), [float(x) for x in r["v"]]) for r in rows.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("v")).collect()]
    found = explain.zero_shot(rows.select("vec_id", F.col("embedding").alias("vec")), "vec_id", prompts, 10.0)
    return found.select("vec_id", "label", _r("p"))


# Geometry


@_query("""WITH d AS (SELECT match_id, sha256_a AS a, sha256_b AS b, coalesce(hamming, 0) AS n FROM match_pairs WHERE sha256_a IS NOT NULL)
SELECT a AS item, max(n) AS inliers, CASE WHEN max(n) > 0 THEN arg_max(b, {'n': n, 'm': -match_id}) END AS peer, round(ln(1 + greatest(max(n), 4)), 6) AS evidence FROM d GROUP BY a""")
def best_geometric_peer(spark, sf_dir):
    rows = _table(spark, sf_dir, "match_pairs").where("sha256_a is not null")
    counted = rows.select(F.lit("all").alias("grp"), F.col("sha256_a").alias("item"), F.col("match_id").alias("pos"), F.col("sha256_b").alias("peer"), F.coalesce("hamming", F.lit(0)).alias("inliers"))
    found = geometry.best_peer(counted)
    return found.select("item", "inliers", "peer", F.round(geometry.evidence_value(F.col("inliers")), 6).alias("evidence"))


@_query()
def ransac_matches(spark, sf_dir):
    """Inlier counts between the vectors of neighbouring labels read as descriptors on a grid; the numeric kernel at work.

    A label's neighbour is the next label there is, the first after the last.
    A label comes in pieces of at most n_features rows by vec_id, each with a
    grid of its own, and every piece of a label is matched with every piece of
    the label and of its neighbour.  The first piece has the label as its key,
    the others also have their number.
    """
    scratch = Scratch(spark, "ransac")
    rows = _table(spark, sf_dir, "embeddings").where("label is not null").select("label", "vec_id", "embedding")
    placed = ranking.ranked(rows, "label", [F.col("vec_id").asc(), F.col("embedding").asc()], "no", scratch)
    n = CFG.geometry.n_features
    placed = placed.select("label", F.floor((F.col("no") - 1) / n).cast("int").alias("piece"), F.struct(F.pmod(F.col("no") - 1, F.lit(n)).alias("i"), "embedding").alias("e"))
    pieces = placed.groupBy("label", "piece").agg(F.array_sort(F.collect_list("e")).alias("e"))
    label = F.col("label").cast("string")
    features = pieces.select(
        "label", F.when(F.col("piece") == 0, label).otherwise(F.concat_ws("/", label, "piece")).alias("key"),
        F.transform("e", lambda x: F.struct((x["i"] % 16).cast("float").alias("x"), F.floor(x["i"] / 16).cast("float").alias("y"))).alias("points"), F.transform("e", lambda x: x["embedding"]).alias("descriptors"),
    )
    features = scratch.save(features, "features")
    numbered = scratch.save(ranking.ranked(features.select("label", F.lit("all").alias("one")).distinct(), "one", [F.col("label").asc()], "no", scratch).select("label", "no"), "labels")
    following = numbered.select((F.pmod(F.col("no"), F.lit(max(1, numbered.count()))) + 1).alias("no"), F.col("label").alias("from")).join(numbered, "no").select("from", "label")
    other = numbered.select(F.col("label").alias("from"), "label").unionByName(following)
    keys = features.select("label", "key")
    pairs = keys.select(F.col("label").alias("from"), F.col("key").alias("a")).join(other, "from").join(keys.select("label", F.col("key").alias("b")), "label")
    return geometry.inliers(pairs.select("a", "b"), features.select("key", "points", "descriptors"))


# Evaluation


_HARD = """, parts AS (SELECT grp, generate_subscripts(vec, 1) AS i, unnest(vec) AS x FROM items), mean AS (SELECT grp, i, avg(x) AS x FROM parts GROUP BY grp, i),
norm AS (SELECT grp, sqrt(sum(x * x)) AS n FROM mean GROUP BY grp),
near AS (SELECT a.grp, b.grp AS donor, sum(a.x / na.n * b.x / nb.n) AS cos FROM mean a JOIN mean b ON a.i = b.i AND a.grp <> b.grp JOIN norm na ON na.grp = a.grp JOIN norm nb ON nb.grp = b.grp GROUP BY a.grp, b.grp)
SELECT grp, donor FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY cos DESC, donor) AS r FROM near) WHERE r = 1"""


@_query("WITH " + q.EMB + _HARD)
def hard_donors(spark, sf_dir):
    items = Scratch(spark, "hard").save(_embeddings(spark, sf_dir), "items")
    return harness.nearest_groups(items, items.select("grp").distinct())


@_query("WITH " + ",\n".join([q.EMB, q.SCORED, q.DONORS]) + """
, target AS (SELECT grp FROM (SELECT grp, n, row_number() OVER (ORDER BY sha256('0|target|' || grp), grp) AS r FROM ring) WHERE r <= greatest(1, round_even(n * 0.5, 0))),
easy AS (SELECT grp, row_number() OVER (ORDER BY sha256('0|easy|' || grp), grp) AS r, count(*) OVER () AS n FROM ring),
pick AS (SELECT a.grp, b.grp AS donor FROM easy a JOIN easy b ON b.r = a.r % a.n + 1 WHERE a.grp IN (SELECT grp FROM target))
SELECT p.grp, '__inj__' || p.donor || '__' || arg_min(i.item, sha256('0|plant|' || p.grp || '|' || p.donor || '|' || i.item)) AS item FROM pick p JOIN items i ON i.grp = p.donor GROUP BY p.grp, p.donor""")
def inject_easy(spark, sf_dir):
    items, scores, scratch = _stored_scores(spark, sf_dir, "inject")
    groups = scores.where("n_scored >= 2").select("grp").distinct()
    chosen = harness.targets(groups, CFG.harness.inject_fraction, 0)
    pairs = calibrate.donors(groups, 0, "easy").join(chosen, "grp", "left_semi")
    rows = items.select("grp", F.col("item").cast("string").alias("item"), F.concat_ws(":", "grp", "item").alias("sha"), F.lit(True).alias("readable"), F.lit(None).cast("binary").alias("bits"))
    rows = scratch.save(rows, "rows")
    return harness.planted(rows, rows, pairs, 1, 0).select("grp", "item")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored evaluations as scored rows: an audited photo's verdict would be the label; here it is the flag."""
    rows = _table(spark, sf_dir, "image_evals").where("kind is not null")
    return rows.select("kind", F.nanvl("suspicion", F.lit(None).cast("double")).alias("score"), F.coalesce("flagged", F.lit(False)).alias("label"), F.coalesce(F.col("z") < -1.0, F.lit(False)).alias("candidate"))


_LABELLED = "rows AS (SELECT kind, CASE WHEN isnan(suspicion) THEN NULL ELSE suspicion END AS score, coalesce(flagged, false) AS label, coalesce(z < -1, false) AS candidate FROM image_evals WHERE kind IS NOT NULL)"


def _threshold_sql() -> str:
    at = ", ".join(f"({t})" for t in harness.THRESHOLDS)
    return f"""{_LABELLED}, t AS (SELECT CAST(x AS DOUBLE) AS threshold FROM (VALUES {at}) v(x)),
c AS (SELECT r.kind, t.threshold, count(*) FILTER (WHERE candidate AND score >= threshold) AS n_flagged, count(*) FILTER (WHERE candidate AND score >= threshold AND label) AS tp, count(*) FILTER (WHERE label) AS n_pos FROM rows r, t GROUP BY r.kind, t.threshold),
pr AS (SELECT *, CASE WHEN n_flagged > 0 THEN tp / n_flagged::DOUBLE ELSE 0 END AS "precision", CASE WHEN n_pos > 0 THEN tp / n_pos::DOUBLE ELSE 0 END AS recall FROM c),
fb AS (SELECT *, CASE WHEN 0.25 * "precision" + recall > 0 THEN 1.25 * "precision" * recall / (0.25 * "precision" + recall) ELSE 0 END AS f_beta, CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END AS f1 FROM pr)"""


@_query("WITH " + _threshold_sql() + ' SELECT kind, threshold, n_flagged, tp, n_pos, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, round(f_beta, 6) AS f_beta FROM fb')
def pr_table(spark, sf_dir):
    table = harness.pr_table(_labelled(spark, sf_dir), ["kind"])
    return table.select("kind", "threshold", "n_flagged", "tp", "n_pos", *[_r(c, 6) for c in ("precision", "recall", "f1", "f_beta")])


@_query("WITH " + _threshold_sql() + ' SELECT kind, threshold, round(f_beta, 6) AS f_beta, round("precision", 6) AS "precision" FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY f_beta DESC, "precision" DESC, threshold) AS r FROM fb) WHERE r = 1')
def best_threshold(spark, sf_dir):
    return harness.best_threshold(harness.pr_table(_labelled(spark, sf_dir), ["kind"]), ["kind"]).select("kind", "threshold", _r("f_beta", 6), _r("precision", 6))


@_query(f"""WITH {_LABELLED}, g AS (SELECT kind, score, count(*) AS n, count(*) FILTER (WHERE label) AS pos FROM rows WHERE score IS NOT NULL GROUP BY kind, score),
r AS (SELECT *, sum(n) OVER w AS seen, sum(pos) OVER w AS found FROM g WINDOW w AS (PARTITION BY kind ORDER BY score DESC))
SELECT kind, round(CASE WHEN sum(pos) > 0 THEN sum(pos * found / seen::DOUBLE) / sum(pos) ELSE 0 END, 6) AS ap FROM r GROUP BY kind""")
def average_precision(spark, sf_dir):
    return harness.average_precision(_labelled(spark, sf_dir), ["kind"]).select("kind", _r("ap", 6))


@_query(f"""WITH {_LABELLED}, pool AS (SELECT * FROM rows UNION ALL SELECT 'all', score, label, candidate FROM rows),
k AS (SELECT kind, count(*) AS n_scored, count(*) FILTER (WHERE label) AS n_foreign FROM pool GROUP BY kind),
s AS (SELECT kind, 'raw' AS how, score AS x, label FROM pool WHERE score IS NOT NULL UNION ALL SELECT kind, 'gated', CASE WHEN candidate THEN coalesce(score, 0) ELSE 0 END, label FROM pool),
g AS (SELECT kind, how, x, count(*) AS n, count(*) FILTER (WHERE label) AS pos FROM s GROUP BY kind, how, x),
r AS (SELECT *, sum(n) OVER w AS seen, sum(pos) OVER w AS found FROM g WINDOW w AS (PARTITION BY kind, how ORDER BY x DESC)),
ap AS (SELECT kind, how, CASE WHEN sum(pos) > 0 THEN sum(pos * found / seen::DOUBLE) / sum(pos) ELSE 0 END AS ap FROM r GROUP BY kind, how)
SELECT CAST(2.5 AS DOUBLE) AS z, k.kind AS pool, k.n_scored, k.n_foreign, round(coalesce(a.ap, 0), 6) AS ap_raw, round(coalesce(b.ap, 0), 6) AS ap_gated
FROM k LEFT JOIN ap a ON a.kind = k.kind AND a.how = 'raw' LEFT JOIN ap b ON b.kind = k.kind AND b.how = 'gated'""")
def evaluation_runs(spark, sf_dir):
    """Sizes and average precisions of runs, with and without the gate; the stored evaluations are the runs, their kind the mode."""
    rows = _labelled(spark, sf_dir).withColumnRenamed("kind", "mode").withColumn("z", F.lit(2.5))
    return documents.run_summary(harness.pooled(rows)).select("z", "pool", "n_scored", "n_foreign", _r("ap_raw", 6), _r("ap_gated", 6))


@_query()
def harness_pooled(spark, sf_dir):
    """The transplant harness over all z, seeds and modes; iterative, so there is no SQL for it."""
    scratch = Scratch(spark, "harness")
    items, vectors = _images(spark, sf_dir), _vectors(spark, sf_dir)
    _, ready, ratio = decide.audit(items, vectors, CFG, scratch)
    rows = harness.pooled(harness.run(items, vectors, ready, ratio, CFG, scratch))
    best = harness.best_threshold(harness.pr_table(rows, ["z", "pool"], beta=CFG.harness.beta), ["z", "pool"])
    ap = harness.average_precision(rows, ["z", "pool"], scratch)
    return best.join(ap, ["z", "pool"]).select("z", "pool", "threshold", _r("f_beta"), _r("precision"), _r("recall"), _r("ap"))
