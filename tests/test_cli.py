import json

import numpy as np
import pytest

from peerlens import cli
from peerlens.config import Config, Harness
from peerlens.operators import decide, geometry, harness
from peerlens.operators.scratch import Scratch
from tests.groups import axis, between, fan
from tests.test_decide import leaning


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Six groups with two items each that are unlike the rest: i6 shares its features with peers, i7 has its own."""
    rng = np.random.default_rng(21)
    items, vectors, features, tags, texts = [], [], [], [], []
    for g in range(6):
        home = fan(leaning(g), 6, 0.95 + 0.005 * g, 6 + 8 * g)
        points, shared = rng.uniform(0, 300, (25, 2)), rng.normal(size=(25, 8))
        for k in range(8):
            sha, odd = f"{g}-{k}", k == 7
            v = home[k] if k < 6 else between(axis(6 + 8 * g + k), leaning(g), 0.99 - 0.01 * g)
            items.append((f"g{g}", f"i{k}", sha, True, None))
            vectors.append((sha, [float(x) for x in v]))
            d = rng.normal(size=(25, 8)) if odd else shared + 0.01 * rng.normal(size=(25, 8))
            features.append((sha, [{"x": float(x), "y": float(y)} for x, y in points + k], [[float(x) for x in r] for r in d]))
            tags.append((sha, [0.0, 3.0] if odd else [2.0, 0.0]))
            texts.append((sha, [("other shop", 0.9), ("smudge", 0.1)] if odd else [("corner store", 0.8)]))
    at = tmp_path_factory.mktemp("tables")
    text = "texts array<struct<text:string,conf:double>>"
    named = {
        "items": (items, "outlet string, file_name string, sha256 string, readable boolean, dhash binary"), "vectors": (vectors, "sha string, vec array<double>"), "features": (features, geometry.FEATURES),
        "tags": (tags, "sha string, vec array<double>"), "texts": (texts, f"sha string, {text}"),
        "prompts": ([("scene", "shop", [1.0, 0.0]), ("scene", "street", [0.0, 1.0]), ("brand", "red", [1.0, 0.0]), ("brand", "blue", [0.0, 1.0])], "kind string, label string, vec array<double>"),
    }
    for name, (rows, schema) in named.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def test_run_uses_features_tags_and_text(spark, tables, tmp_path):
    a = lambda n: f"{tables}/{n}.parquet"
    cli.main(["run", "--data", a("items"), "--vectors", a("vectors"), "--out", str(tmp_path), "--features", a("features"), "--tag-vectors", a("tags"), "--prompts", a("prompts"), "--texts", a("texts"), "--report", f"{tmp_path}/page.html", "--single"])
    said = {(r.outlet_id, e.file_name): e.reason for r in spark.read.json(f"{tmp_path}/results_json").collect() for e in r.flagged_images}
    odd = [said["g0", "i7"], said["g1", "i7"]]
    for reason in odd:
        assert "Scene reads as 'street' while 7/7 peers read as 'shop'. Telecom branding reads 'blue' vs 'red' on peers. Signage text 'other shop' shares 0/2 tokens" in reason
        assert "corner store" in reason and "smudge" not in reason and "No geometric match to nearest peers" in reason
    document = json.load(open(f"{tmp_path}/calibration.json"))
    assert document["geometry"]["n_pairs"] == 300 and document["geometry"]["legit_median_inliers"] > 20 > document["geometry"]["foreign_median_inliers"]
    assert list(document["within_pair_quantiles"]) == ["0.05", "0.25", "0.5", "0.75", "0.95"] and document["within_pair_quantiles"]["0.5"] > document["cross_pair_quantiles"]["0.5"]
    assert document["flag_summary"]["n_flagged"] == len(said) and document["folder_review"] == {"floor": 0.45, "outlets": []}
    page = open(f"{tmp_path}/page.html").read()
    assert f"{len(said)} items flagged" in page and "Telecom branding" in page and "geom_inliers" in page
    assert {r["outlet_id"] for r in json.load(open(f"{tmp_path}/results.json"))} == {f"g{g}" for g in range(6)}


def test_evaluate_writes_its_document_and_thresholds(spark, tables, tmp_path, capsys):
    a = lambda n: f"{tables}/{n}.parquet"
    settings = tmp_path / "c.yaml"
    settings.write_text("gate:\n  z_thresh: 2.5\n  p_thresh: 0.3\nharness:\n  seeds: [0]\n  modes: [easy]\n  z_grid: [2.5, 3.5]\n")
    cli.main(["evaluate", "--data", a("items"), "--vectors", a("vectors"), "--out", str(tmp_path), "--config", str(settings), "--no-geometry", "--write-threshold", "--embedder", "clip"])
    document = json.load(open(f"{tmp_path}/eval_clip_nogeom.json"))
    assert set(document["runs"]) == {f"z={z}|{m}" for z in (2.5, 3.5) for m in ("easy", "all")}
    one = document["runs"]["z=2.5|easy"]
    assert one["n_foreign"] == 3 and one["n_scored"] == 51 and len(one["table"]) == 25 and 0 < one["ap_gated"] <= 1
    point = document["operating_point"]
    assert f"p_thresh: {point['threshold']}" in settings.read_text() and "ap_raw" in capsys.readouterr().out


def test_harness_and_switch_use_geometry(spark, tables):
    from peerlens.sources.images import items_of

    read = lambda n: spark.read.parquet(f"{tables}/{n}.parquet")
    items, vectors, features = items_of(read("items")), read("vectors"), read("features")
    cfg, scratch = Config(harness=Harness(seeds=(0,), modes=("easy",), z_grid=(2.5, 3.5))), Scratch(spark, "t")
    _, ready, ratio = decide.audit(items, vectors, cfg, scratch, features)
    with_it, without = ({(r.z, r.grp, r["item"]): r.score for r in harness.run(items, vectors, ready, ratio, cfg, scratch, f).where("candidate").collect()} for f in (features, None))
    assert with_it.keys() == without.keys()
    same = [k for k in with_it if k[2] == "i6"]
    assert {k[0] for k in same} == {2.5, 3.5} and all(with_it[k] < without[k] for k in same)


def test_options(tables):
    for wrong in (["run", "--data", "x.parquet", "--prompts", "p.parquet"], ["run", "--data", "x.parquet"], ["evaluate", "--data", "x", "--write-threshold"], ["run", "--data", "x", "--embedder", "clip"]):
        with pytest.raises(SystemExit):
            cli.main(wrong)


def test_run_on_images(spark, tmp_path):
    """A folder of pictures: vectors are computed once, and the page shows thumbnails."""
    from peerlens.operators.page import png

    rng = np.random.default_rng(2)
    for g in range(3):
        base = rng.integers(0, 255, (48, 64, 3))
        (tmp_path / f"data/g{g}").mkdir(parents=True)
        for k in range(5):
            pixels = np.clip(base + rng.integers(-90, 90, base.shape) if k < 4 else rng.integers(0, 255, base.shape), 0, 255).astype(np.uint8)
            (tmp_path / f"data/g{g}/p{k}.png").write_bytes(png(pixels))
        (tmp_path / f"data/g{g}/copy.png").write_bytes((tmp_path / f"data/g{g}/p0.png").read_bytes())
    (tmp_path / "c.yaml").write_text(f"cache_dir: {tmp_path}/cache\n")
    for _ in range(2):
        cli.main(["run", "--data", f"{tmp_path}/data", "--out", f"{tmp_path}/out", "--config", f"{tmp_path}/c.yaml", "--report"])
    assert spark.read.parquet(f"{tmp_path}/cache/vectors/tag=phash").count() == 15
    page = open(f"{tmp_path}/out/report.html").read()
    assert page.count("data:image/png;base64,") >= 6 and "Identical copy of copy.png" in page
