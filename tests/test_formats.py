"""JPEG against the JVM's own codec, shards by address, bins of quotas on both sides of the driver's limit, restarts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.cli import main
from siftwell.config import SelectionOptions, parse_ids
from siftwell.operators import kmeans, raster, selection
from siftwell.sources import arrow_shards, jpeg
from siftwell.tables import settle, settled, shared_folder


def _picture(h, w):
    y, x = np.mgrid[:h, :w]
    return np.stack([128 + 90 * np.sin(x / 11), 128 + 90 * np.cos(y / 13), 60 + 120 * ((x // 16 + y // 16) % 2)], -1).clip(0, 255).astype(np.uint8)


def _jvm_read(spark, data):
    jvm = spark._jvm
    image = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(bytearray(data)))
    h, w = image.getHeight(), image.getWidth()
    if image.getRaster().getNumBands() == 1:  # its samples: getRGB would bend the greys
        gray = np.array(list(image.getRaster().getSamples(0, 0, w, h, 0, spark.sparkContext._gateway.new_array(jvm.int, h * w))), np.uint8)
        return np.repeat(gray.reshape(h, w, 1), 3, axis=2)
    flat = np.array(list(image.getRGB(0, 0, w, h, None, 0, w)), np.int64).reshape(h, w)
    return np.stack([flat >> 16 & 255, flat >> 8 & 255, flat & 255], -1).astype(np.uint8)


def _jvm_write(spark, rgb, gray=False):
    jvm = spark._jvm
    h, w, _ = rgb.shape
    image = jvm.java.awt.image.BufferedImage(w, h, 10 if gray else 1)
    for y in range(h):
        for x in range(w):
            r, g, b = (int(v) for v in rgb[y, x])
            image.setRGB(x, y, (r << 16 | g << 8 | b) - (1 << 24))
    out = jvm.java.io.ByteArrayOutputStream()
    jvm.javax.imageio.ImageIO.write(image, "jpg", out)
    return bytes(out.toByteArray())


@pytest.mark.parametrize(("h", "w", "quality"), [(1, 1, 95), (8, 8, 50), (37, 61, 95), (37, 61, 20), (64, 16, 100)])
def test_written_jpeg_is_read_by_the_jvm(spark, h, w, quality):
    rgb = _picture(h, w)
    data = jpeg.encode(rgb, quality)
    other = _jvm_read(spark, data)
    assert other.shape == rgb.shape and np.abs(jpeg.decode(data).astype(int) - other).max() <= 3
    assert quality < 90 or np.abs(other.astype(int) - rgb).mean() < 4


@pytest.mark.parametrize(("h", "w", "gray"), [(19, 23, False), (16, 16, False), (20, 9, True), (1, 3, False)])
def test_jpeg_of_the_jvm_is_read(spark, h, w, gray):
    data = _jvm_write(spark, _picture(h, w), gray)  # colours at half the resolution
    assert np.abs(jpeg.decode(data).astype(int) - _jvm_read(spark, data)).mean() < 8


def test_noise_and_odd_jpegs():
    rgb = np.random.default_rng(0).integers(0, 256, (40, 40, 3)).astype(np.uint8)
    assert np.abs(jpeg.decode(jpeg.encode(rgb, 100)).astype(int) - rgb).max() <= 4
    flat = np.full((9, 9, 3), 77, np.uint8)
    assert np.abs(jpeg.decode(jpeg.encode(flat)).astype(int) - flat).max() <= 1
    data = jpeg.encode(rgb)
    for broken in (b"", b"\xff\xd8", data[:100], data.replace(b"\xff\xc0", b"\xff\xc2")):
        with pytest.raises(ValueError):
            jpeg.decode(broken)


def test_shards_by_address(spark, tmp_path):
    import pyarrow as pa

    shard = pa.table({"jpg": pa.array([{"bytes": b"x", "path": "p"}] * 3, pa.struct([("bytes", pa.binary()), ("path", pa.string())]))})
    for name in ("a.arrow", "b.arrow"):
        with pa.OSFile(str(tmp_path / name), "wb") as sink, pa.ipc.new_file(sink, shard.schema) as writer:
            writer.write_table(shard)
    assert arrow_shards.read_shards(spark, f"file://{tmp_path}").count() == 6
    files = arrow_shards.discover(f"file://{tmp_path}")
    assert arrow_shards.read_shards(spark, f"file://{tmp_path}", files=files[1:]).count() == 3


@pytest.mark.parametrize("seed", range(6))
def test_quotas_do_not_depend_on_the_number_of_bins(spark, monkeypatch, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]) if k else "a", k, rng.choice([1, 3, 9, 40, 200])) for k in range(rng.choice([1, 10, 25]))]
    counts = spark.createDataFrame(rows, "kind string, k int, n long")
    options = SelectionOptions(rng.choice([0, 7, 85, 300]), ("kind", "k"), rng.choice([0.0, 0.5, 1.0]), per_bin_min_quota=rng.choice([0, 3, 8]), strict_target=seed % 3 > 0)
    told = lambda: sorted((str(r["kind"]), r["k"], r["quota"]) for r in selection.quota_table(counts, ("kind", "k"), options).collect())
    here = told()
    monkeypatch.setattr(selection, "DRIVER_BINS", 0)
    assert told() == here


def test_strict_target_beyond_the_drivers_bins(spark, monkeypatch):
    counts = spark.createDataFrame([(k, 100 if k < 3 else 8) for k in range(10)], "k int, n long")
    options = SelectionOptions(85, ("k",), 1.0, per_bin_min_quota=8, strict_target=True)
    for limit in (100_000, 0):
        monkeypatch.setattr(selection, "DRIVER_BINS", limit)
        assert selection.quota_table(counts, ("k",), options).agg(F.sum("quota")).first()[0] == 85


def test_seeds_and_rounds_go_on_after_a_break(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(kmeans, "REFRESH", 2)
    rng = np.random.default_rng(1)
    points = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=3) + 9 * (i % 7)]) for i in range(140)], "point_id long, embedding array<double>")
    whole, _, pot = kmeans.kmeans(points, 7, 5, seed=3)

    class Broken(Exception):
        pass

    calls = {"n": 0}
    real = kmeans.centroids

    def break_off(*a):
        calls["n"] += 1
        if calls["n"] == 2:
            raise Broken
        return real(*a)

    monkeypatch.setattr(kmeans, "centroids", break_off)
    with pytest.raises(Broken):
        kmeans.kmeans(points, 7, 5, seed=3, keep=str(tmp_path / "k"))
    kept = kmeans.Kept(spark, str(tmp_path / "k" / "run-0"))
    assert kept.read("round")[0] == 1 and len(kept.read("seeds")[1]) in (5, 6, 7)
    monkeypatch.setattr(kmeans, "plusplus_init", None)  # a run that goes on draws no seeds
    again, _, pot2 = kmeans.kmeans(points, 7, 5, seed=3, keep=str(tmp_path / "k"))
    assert np.allclose(again, whole) and abs(pot - pot2) < 1e-9


def test_seeding_equals_a_pass_over_all_centres(spark, monkeypatch):
    points = spark.createDataFrame([(i, [float(i % 9), float(i // 9)]) for i in range(81)], "point_id long, embedding array<double>")
    ids = []
    for refresh in (1, 3, 100):
        monkeypatch.setattr(kmeans, "REFRESH", refresh)
        ids.append(kmeans.plusplus_init(points, 9, 5)[1])
    assert ids[0] == ids[1] == ids[2] and len(set(ids[0])) == 9


def test_tables_go_when_they_have_served(spark):
    inner = []

    def make():
        inner.append(settle(spark.range(5)))
        return inner[0].where("id > 2")

    out = settled(make)
    assert sorted(r["id"] for r in out.collect()) == [3, 4]
    with pytest.raises(Exception, match="(?i)not.*exist|not.*found"):
        spark.read.parquet(inner[0].settled_path).count()


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master, applicationId = "spark://host:7077", "app-1"

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="all executors share"):
        shared_folder(Session)


def test_a_broken_run_of_local_select_goes_on(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    from siftwell.operators import tiling
    from siftwell.sources.arrays import synthetic_images

    rows = synthetic_images(spark, 6, 64).collect()
    for name in sorted({r["source_shard"] for r in rows}):
        own = [{"bytes": bytes(r["jpg"]["bytes"]) if r["source_index"] else b"junk", "path": "p"} for r in rows if r["source_shard"] == name]
        table = pa.table({"jpg": pa.array(own, pa.struct([("bytes", pa.binary()), ("path", pa.string())])), "json": pa.array([r["json"] for r in rows if r["source_shard"] == name])})
        with pa.OSFile(str(tmp_path / name), "wb") as sink, pa.ipc.new_file(sink, table.schema) as writer:
            writer.write_table(table)
    local = ["local-select", "--data_dir", str(tmp_path), "--output_dir", f"{tmp_path}/l", "--patch_size", "32", "--magnification_factors", "1.0", "--shards_per_batch", "1"]
    real, seen = tiling.select_and_report, []

    def break_off(images, options):
        seen.append(1)
        if len(seen) == 3:
            raise RuntimeError("broken off")
        return real(images, options)

    monkeypatch.setattr(tiling, "select_and_report", break_off)
    with pytest.raises(RuntimeError, match="broken off"):
        main(local, spark)
    told = main(local, spark)
    assert len(seen) == 5 and told["images"] == 6 and told["failed"] == 4 and told["selected"] > 0


def test_stains_and_ids():
    rgb = _picture(12, 12)
    weak, strong = (raster.hed_jitter(rgb, s, 3) for s in ("weak", "strong"))
    assert weak.shape == rgb.shape and (weak == raster.hed_jitter(rgb, "weak", 3)).all() and (weak != strong).any()
    with pytest.raises(ValueError):
        raster.hed_jitter(rgb, "loud", 3)
    assert parse_ids("2, 0,2") == (2, 0) and parse_ids("") == ()
    with pytest.raises(ValueError):
        parse_ids("-1")
