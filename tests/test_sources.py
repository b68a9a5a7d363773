import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerlens import config
from peerlens.sources.cache import ContentCache, missing
from peerlens.sources.images import get_embedder, images
from peerlens.streaming.incremental import rescoring


def png(pixels):
    """A gray PNG of an array."""
    h, w = pixels.shape
    raw = b"".join(b"\0" + pixels[i].astype(np.uint8).tobytes() for i in range(h))
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    rng = np.random.default_rng(0)
    a = rng.integers(0, 255, (40, 30))
    for g, name, content in (("g", "a.PNG", png(a)), ("g", "b.png", png(a)), ("g", "bad.jpg", b"nothing"), ("h", "c.png", png(255 - a)), ("h", "notes.txt", b"text")):
        (root / g).mkdir(exist_ok=True)
        (root / g / name).write_bytes(content)
    return str(root)


def test_scan(spark, folder):
    rows = {(r.grp, r["item"]): r for r in images(spark, folder).collect()}
    assert set(rows) == {("g", "a.PNG"), ("g", "b.png"), ("g", "bad.jpg"), ("h", "c.png")}
    assert rows["g", "a.PNG"].sha == rows["g", "b.png"].sha and rows["g", "a.PNG"].bits == rows["g", "b.png"].bits and len(rows["g", "a.PNG"].bits) == 32
    assert not rows["g", "bad.jpg"].readable and rows["g", "bad.jpg"].bits is None and rows["h", "c.png"].readable


def test_embedder(spark, folder):
    vecs = [np.array(r.vec) for r in get_embedder("phash").embed(spark, folder).collect()]
    assert len(vecs) == 2 and vecs[0] @ vecs[1] < -0.9
    with pytest.raises(ValueError, match="no embedder"):
        get_embedder("vgg")


def test_cache(spark, tmp_path):
    cache = ContentCache(spark, f"{tmp_path}/c", "m1", "sha string, n int")
    wanted = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "sha string")
    calls = []

    def compute(misses):
        calls.append(sorted(r.sha for r in misses.collect()))
        return misses.select("sha", F.lit(1).alias("n"))

    assert cache.fill(wanted, compute).count() == 2 and cache.fill(wanted, compute).count() == 2
    assert calls == [["a", "b"], []] and missing(wanted, cache.read()).count() == 0


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("gate:\n  z_thresh: 2.5        # cut\n  p_thresh: 0.3\nharness:\n  seeds: [1, 2]\n")
    config.set_values(str(path), {"z_thresh": 3.0})
    assert "  z_thresh: 3.0        # cut\n" in path.read_text()
    cfg = config.Config.load(str(path))
    assert cfg.gate.z_thresh == 3.0 and cfg.harness.seeds == (1, 2) and cfg.gate.mad_floor == 0.01
    with pytest.raises(KeyError):
        config.set_values(str(path), {"absent": 1})
    path.write_text("gate:\n  nonsense: 1\n")
    with pytest.raises(KeyError):
        config.Config.load(str(path))


def test_stream(spark, tmp_path):
    rows = [("g", "a", [1.0, 0.0]), ("g", "b", [0.0, 1.0])]
    spark.createDataFrame(rows, "grp string, item string, vec array<double>").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("grp string, item string, vec array<double>").parquet(f"{tmp_path}/in")
    seen = []
    query = rescoring(spark, stream, f"{tmp_path}/store", lambda df, n: seen.append(sorted((r.grp, r["item"]) for r in df.collect()))).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert seen == [[("g", "a"), ("g", "b")]]
    spark.createDataFrame([("h", "z", [1.0, 0.0]), ("h", "y", [1.0, 0.0])], "grp string, item string, vec array<double>").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    query = rescoring(spark, stream, f"{tmp_path}/store", lambda df, n: seen.append(sorted((r.grp, r["item"]) for r in df.collect()))).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert seen[1] == [("h", "y"), ("h", "z")]


def test_command_line(spark, folder, tmp_path, capsys):
    from peerlens import cli

    cli.main(["profile", "--data", folder])
    out = capsys.readouterr().out
    assert '"n_groups": 2' in out and '"n_resolutions": 1' in out and '"30x40"' in out and '"first_unreadable": ["g/bad.jpg"]' in out and '"with_exif": 0' in out


def test_exif_and_orientation():
    from peerlens.functions.exif import exif
    from peerlens.functions.hashing import dhash, phash, turned

    def jpeg(order, *entries):
        head = b"II*\0" if order == "<" else b"MM\0*"
        body = head + struct.pack(order + "IH", 8, len(entries)) + b"".join(struct.pack(order + "HHI", t, 3, 1) + struct.pack(order + "H", v) + b"\0\0" for t, v in entries)
        return b"\xff\xd8\xff\xe0\0\x04ab\xff\xe1" + struct.pack(">H", len(body) + 8) + b"Exif\0\0" + body + b"\xff\xd9"

    assert exif(jpeg("<", (0x0112, 6))) == (6, True, False, False) and exif(jpeg(">", (0x0112, 3), (0x0132, 1), (0x8825, 1))) == (3, True, True, True)
    for nothing in (b"", b"\xff\xd8", b"\x89PNG", jpeg("<", (0x0112, 99))[:-9], b"\xff\xd8\xff\xe1\0\x0aExif\0\0"):
        assert exif(nothing)[0] == 1
    a = np.arange(6).reshape(2, 3)
    want = {1: a, 2: np.fliplr(a), 3: np.rot90(a, 2), 4: np.flipud(a), 5: a.T, 6: np.rot90(a, -1), 7: np.rot90(a, 2).T, 8: np.rot90(a)}
    assert all((turned(a, o) == want[o]).all() for o in want)
    image = np.random.default_rng(1).integers(0, 255, (50, 70)).astype(float)
    for o in range(1, 9):
        assert dhash(image, orientation=o) == dhash(turned(image, o)) and np.allclose(phash(image, o), phash(turned(image, o)))
