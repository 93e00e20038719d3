"""Rasters, tiles, neighbours, scores, the coreset, sources, sinks and incremental runs."""

import json
import tarfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell import config
from siftwell.config import PatchOptions
from siftwell.functions import text
from siftwell.operators import export, raster, tiling
from siftwell.operators.coreset import select_coreset
from siftwell.operators.neighbors import neighbor_features
from siftwell.operators.scores import local_scores
from siftwell.schemas import BASE_FEATURES, CANDIDATE, FEATURES
from siftwell.sources import arrow_shards, codec
from siftwell.sources.arrays import synthetic_images
from siftwell.streaming import incremental


def _flood(mask):
    """Components by flood fill."""
    out, n = np.zeros(mask.shape, int), 0
    for y, x in zip(*np.nonzero(mask), strict=True):
        if not out[y, x]:
            n += 1
            todo = [(y, x)]
            while todo:
                a, b = todo.pop()
                if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not out[a, b]:
                    out[a, b] = n
                    todo += [(a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)]
    return out, n


def test_labels_equal_flood_fill():
    rng = np.random.default_rng(3)
    for _ in range(30):
        mask = rng.random((rng.integers(1, 20), rng.integers(1, 20))) < rng.random()
        got, n = raster.label(mask)
        want, m = _flood(mask)
        assert n == m and len({(a, b) for a, b in zip(got[mask], want[mask], strict=True)}) == n
        assert sorted(raster.areas(mask)) == sorted(np.bincount(want[mask], minlength=m + 1)[1:])


def test_morphology():
    ring = np.zeros((7, 7), bool)
    ring[1:6, 1:6] = True
    ring[3, 3] = False
    assert raster.fill_holes(ring).sum() == 25
    dot = np.zeros((5, 5), bool)
    dot[2, 2] = True
    assert raster.dilate(dot, 1).sum() == 5 and raster.dilate(dot, 2).sum() == 13
    assert raster.erode(raster.dilate(dot, 1), 1).sum() == 1
    assert not raster.erode(np.ones((3, 3), bool), 1)[0].any()
    assert raster.drop_small(dot, 2).sum() == 0


def test_filters_on_a_ramp():
    x = np.tile(np.arange(10, dtype=np.float32), (10, 1))
    assert np.allclose(raster.gradient(x)[2:-2, 2:-2], 8) and np.allclose(raster.laplace(x)[2:-2, 2:-2], 0)
    assert np.allclose(raster.box_mean(x, 3)[:, 1:-1], x[:, 1:-1])
    assert np.allclose(raster.local_std(np.full((9, 9), 0.5, np.float32)), 0, atol=1e-3)


def test_resizing():
    rgb = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    half = raster.resize(rgb, 2, 2)
    assert half.shape == (2, 2, 3) and abs(int(half.mean()) - int(rgb.mean())) <= 1
    flat = np.full((9, 5, 3), 77, np.uint8)
    assert (raster.resize(flat, 13, 4) == 77).all()
    assert raster.resize_mask(np.eye(4, dtype=bool), 2, 2).tolist() == [[True, False], [False, True]]


def test_rle():
    assert raster.decode_rle("1 2", 2, 2).tolist() == [[True, False], [True, False]]
    for bad in (None, "", "1", "1 x", "0 1", "4 2"):
        assert raster.decode_rle(bad, 2, 2) is None


def test_png_round_trip():
    rgb = np.random.default_rng(0).integers(0, 256, (9, 7, 3)).astype(np.uint8)
    assert (codec.decode(codec.encode_png(rgb)) == rgb).all()
    with pytest.raises(ValueError):
        codec.decode_png(b"nonsense")


def test_png_filters():
    import struct
    import zlib

    rng = np.random.default_rng(1)
    rgb = rng.integers(0, 256, (6, 5, 3)).astype(np.int64)
    lines, above = [], np.zeros(15, np.int64)
    for y in range(6):
        line, kind = rgb[y].reshape(-1), y % 5
        left, corner = np.concatenate([np.zeros(3, np.int64), line[:-3]]), np.concatenate([np.zeros(3, np.int64), above[:-3]])
        p = left + above - corner
        a, b, c = abs(p - left), abs(p - above), abs(p - corner)
        paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))
        guess = [0, left, above, (left + above) // 2, paeth][kind]
        lines.append(bytes([kind]) + ((line - guess) % 256).astype(np.uint8).tobytes())
        above = line
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 6, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (codec.decode_png(data) == rgb).all()


def test_descriptor_is_finite_and_shares_add_up():
    rng = np.random.default_rng(2)
    rgb = rng.integers(60, 200, (48, 48, 3)).astype(np.uint8)
    o = PatchOptions()
    f = dict(zip(BASE_FEATURES, raster.describe(rgb, raster.slide_stats(rgb, o), o), strict=True))
    assert all(np.isfinite(v) for v in f.values())
    assert abs(sum(v for k, v in f.items() if k.startswith("h_hist")) - 1) < 1e-5
    assert raster.describe(np.full((32, 32, 3), 255, np.uint8), raster.slide_stats(rgb, o), o) is None


def test_tiles_of_a_small_image():
    rgb = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    fake = lambda image, stats, o, mask: np.zeros(42, np.float32)
    o = PatchOptions(patch_size=2, patch_stride=2, magnification_factors=(1.0, 0.5))
    got = tiling.tiles_of(rgb, None, o, fake, lambda *a: None)
    assert [t["scale_level"] for t in got] == [0, 0, 0, 0, 1]
    assert [(t["scaled_image_width"], t["scaled_image_height"]) for t in got] == [(4, 4)] * 4 + [(2, 2)]
    masked = tiling.tiles_of(rgb, "1 8", o, fake, lambda *a: None)
    assert [(t["patch_x"], t["patch_y"], t["patch_index"]) for t in masked if t["scale_level"] == 0] == [(0, 0, 0), (0, 2, 1)]


def test_relational_grid_equals_the_fused_one(spark):
    o = PatchOptions(patch_size=3, patch_stride=2, magnification_factors=(1.0, 0.5))
    fake = lambda image, stats, o, mask: np.zeros(42, np.float32)
    fused = tiling.tiles_of(np.zeros((9, 8, 3), np.uint8), None, o, fake, lambda *a: None)
    grid = tiling.tile_grid(spark.createDataFrame([("a", 8, 9)], "sample_id string, image_width int, image_height int"), o).collect()
    key = lambda t: (t["scale_level"], t["grid_row"], t["grid_col"], t["patch_x"], t["patch_y"])
    assert sorted(map(key, fused)) == sorted(map(key, grid))


def _tiles(spark, places, value=lambda k, f: (k * 7 + f * 3) % 11 / 11):
    rows = [("a", k, s, r, c, *[float(value(k, f)) for f in range(42)]) for k, (s, r, c) in enumerate(places)]
    return spark.createDataFrame(rows, "sample_id string, patch_index int, scale_level int, grid_row int, grid_col int, " + ", ".join(f"{f} float" for f in BASE_FEATURES))


def test_neighbours_never_cross_scales(spark):
    got = neighbor_features(_tiles(spark, [(0, 0, 0), (1, 0, 0)])).collect()
    assert all(r[c] == 0 for r in got for c in FEATURES[42:])


def test_scores_and_roles(spark):
    tiles = _tiles(spark, [(0, r, c) for r in range(5) for c in range(6)])
    scored = local_scores(neighbor_features(tiles))
    o = PatchOptions(local_keep_ratio=0.2, local_keep_max=6)
    got = select_coreset(scored, o).collect()
    assert len(got) == 6 and sorted(r["selection_rank"] for r in got) == [1, 2, 3, 4, 5, 6]
    assert [r["selection_role"] for r in got].count("coverage_fill") == 2
    objective = [r["objective_score"] for r in sorted(got, key=lambda r: r["selection_rank"])]
    assert objective == sorted(objective, reverse=True)
    every = scored.collect()
    first = min(every, key=lambda r: (-r["prototype_score"], -r["objective_score"], r["patch_index"]))
    assert {r["patch_index"] for r in got if r["selection_role"] == "prototype"} == {first["patch_index"]}
    # model of the greedy rest
    chosen = {r["patch_index"]: r for r in got if r["selection_role"] != "coverage_fill"}
    while len(chosen) < 6:
        seen_s, seen_i = {r["state_bin"] for r in chosen.values()}, {r["interface_bin"] for r in chosen.values()}
        gain = lambda r: r["objective_score"] + 0.35 * (r["state_bin"] not in seen_s) + 0.2 * (r["interface_bin"] not in seen_i)  # noqa: B023, E731
        best = min((r for r in every if r["patch_index"] not in chosen), key=lambda r: (-gain(r), r["patch_index"]))
        chosen[best["patch_index"]] = best
    assert set(chosen) == {r["patch_index"] for r in got}


def test_a_single_tile_is_retained(spark):
    got = select_coreset(local_scores(neighbor_features(_tiles(spark, [(0, 0, 0)])))).collect()
    assert got[0]["selection_role"] == "all_retained" and got[0]["rarity_score"] == 0 and got[0]["selection_rank"] == 1


def test_metadata(spark):
    rows = [
        ('{"custom_metadata": {"marker": "G", "organ": "Liver", "cancer": true}}',),
        ('{"custom_metadata": "{\\"gene\\": \\"H\\", \\"is_cancer\\": \\"benign\\", \\"rle_mask\\": \\"1 2\\"}"}',),
        ('{"title": "A Sarcoma", "cell line": "x"}',), ("[1, 2]",), (None,), ("broken",),
    ]
    m = text.custom_metadata(F.col("j"))
    df = spark.createDataFrame(rows, "j string").select(text.normalize_metadata(m).alias("n"), text.without_large_fields(m).alias("w"))
    got = df.collect()
    assert [(r["n"]["gene"], r["n"]["tissue"], r["n"]["is_cancer"]) for r in got] == [("G", "Liver", 1), ("H", "", 0), ("", "", 1), ("", "", None), ("", "", None), ("", "", None)]
    assert "rle_mask" not in got[1]["w"] and got[2]["n"]["cell_type"] == "x"


def test_names(spark):
    one = spark.range(1).select(
        text.slugify(F.lit("Bone & Marrow-x"), "n").alias("a"), text.slugify(F.lit("***"), "n").alias("b"), text.scale_token(F.lit(1), F.lit(0.25)).alias("c"),
        text.tar_name(F.lit("/d/My Shard.arrow"), "gz", F.lit(3)).alias("d"),
    ).first()
    assert one["a"] == "bone_and_marrow_x" and one["b"] == "n" and one["c"] == "m1_s025"
    assert one["d"].startswith("my_shard_") and one["d"].endswith("_part000003.tar.gz")


def test_options():
    assert config.parse_factors("1.0, 0.5,1.0") == (1.0, 0.5) and config.parse_counts("4,1,4") == (4, 1)
    assert config.parse_image_format(" .PNG") == "png" and config.optional_text(" none ") is None
    for bad in ((), (0.0,)):
        with pytest.raises(ValueError):
            PatchOptions(magnification_factors=bad)
    with pytest.raises(ValueError):
        config.parse_image_format("gif")


def _shard(path, items):
    table = pa.table({"jpg": pa.array([{"bytes": b, "path": p} for b, p, _ in items], pa.struct([("bytes", pa.binary()), ("path", pa.string())])), "json": pa.array([j for *_, j in items], pa.string())})
    path.parent.mkdir(parents=True, exist_ok=True)
    with pa.OSFile(str(path), "wb") as sink, pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table, max_chunksize=2)


@pytest.fixture
def shards(tmp_path):
    red = np.zeros((8, 8, 3), np.uint8)
    red[..., 0] = 200
    png = codec.encode_png(red)
    told = lambda k: json.dumps({"gene": "G", "tissue": "T", "md5": f"m{k}"})
    _shard(tmp_path / "in" / "train-0.arrow", [(png, "a.png", told(0)), (None, "b.png", told(1)), (png, "c.png", told(2))])
    _shard(tmp_path / "in" / "validation-0.arrow", [(png, "d.png", told(3))])
    return tmp_path / "in"


def test_shards(spark, shards):
    rows = arrow_shards.read_shards(spark, str(shards)).collect()
    assert sorted((r["source_shard"][-9:], r["source_index"]) for r in rows) == [("n-0.arrow", 0), ("n-0.arrow", 0), ("n-0.arrow", 1), ("n-0.arrow", 2)]
    assert arrow_shards.read_shards(spark, str(shards), "valid").count() == 1
    assert arrow_shards.with_bytes(arrow_shards.read_shards(spark, str(shards), "train")).count() == 2
    for bad, error in (("test", FileNotFoundError), ("other", ValueError)):
        with pytest.raises(error):
            arrow_shards.discover(str(shards), bad)
    with pytest.raises(FileNotFoundError):
        arrow_shards.discover(str(shards / "none"))


def test_relocated_shards(spark, shards):
    listed = spark.createDataFrame([(p,) for p in arrow_shards.discover(str(shards))], "path string")
    asked = spark.createDataFrame([("/old/TRAIN-0.arrow",), (str(shards / "validation-0.arrow"),), ("/x/gone.arrow",)], "source_shard string")
    got = {r["source_shard"]: r["shard_path"] for r in arrow_shards.resolve_shards(asked, listed).collect()}
    assert got["/old/TRAIN-0.arrow"].endswith("train-0.arrow") and got["/x/gone.arrow"] is None


@pytest.mark.parametrize("mode", export.MODES)
def test_patches_are_exported(spark, shards, tmp_path, mode):
    images = arrow_shards.read_shards(spark, str(shards))
    shard = str(shards / "train-0.arrow")
    rows = [("m0", "m0", shard, 0, k, 4, 4 * (k % 2), 0, 0, 1.0, 8, 8) for k in range(3)] + [("m1", "m1", shard, 1, 0, 4, 0, 0, 0, 1.0, 8, 8)]
    manifest = spark.createDataFrame(rows, "sample_id string, sample_slug string, source_shard string, source_index long, patch_index int, patch_size int, patch_x int, patch_y int, scale_level int, scale_factor double, scaled_image_width int, scaled_image_height int")
    out = tmp_path / mode
    stats = export.export_patches(manifest, images, str(out), mode, per_tar=2)
    told = export.export_summary(stats, str(out / "summary.json"))
    assert told == {"shards": 1, "selected_rows": 4, "written_members": 3, "missing_images": 1}
    tars = sorted(out.glob("*.tar"))
    if mode != "files":
        names = [m.name for t in tars for m in tarfile.open(t).getmembers()]
        assert len(tars) == 2 and len(names) == 3 and names[0] == "m0__i0000000__p0000__m00__x00000__y00000.png"
        data = tarfile.open(tars[0]).extractfile(names[0]).read()
        assert (codec.decode(data)[..., 0] == 200).all()
    if mode != "tar":
        assert len(list(out.glob("*/*.png"))) == 3


def test_null_shards_are_refused(spark, shards):
    manifest = spark.createDataFrame([(None, 0)], "source_shard string, source_index long")
    with pytest.raises(ValueError):
        export.crops(manifest, arrow_shards.read_shards(spark, str(shards)))


def test_whole_images_and_embedded_bytes(spark, shards, tmp_path):
    assert export.export_images(arrow_shards.read_shards(spark, str(shards)), str(tmp_path / "i")) == 3
    assert len(list((tmp_path / "i").iterdir())) == 3
    one, two = (codec.encode_png(np.full((4, 6, 3), c, np.uint8)) for c in (30, 200))
    table = spark.createDataFrame([("a", one), ("a", one), ("b", b""), (None, two), ("d", two), ("e", None)], "task_id string, image_bytes binary")
    assert export.export_embedded(table, str(tmp_path / "e"), limit=1) == 1 and export.export_embedded(table, str(tmp_path / "f")) == 4
    got = {f.name: codec.decode(f.read_bytes()) for f in (tmp_path / "f").iterdir()}
    # places count rows without bytes, repeats have places of their own, and files are what their ending says
    assert sorted(got) == ["a_patch_00002.jpg", "a_patch_00003.jpg", "d_patch_00005.jpg", "patches_patch_00001.jpg"]
    assert all(f.read_bytes()[:2] == b"\xff\xd8" for f in (tmp_path / "f").iterdir()) and np.abs(got["a_patch_00002.jpg"].astype(int) - 30).max() <= 2


def test_image_run(spark):
    o = PatchOptions(patch_size=32, patch_stride=32, magnification_factors=(1.0,))
    images = synthetic_images(spark, 4, 64)
    broken = images.limit(1).select(F.struct(F.lit(b"junk").alias("bytes"), F.lit("x").alias("path")).alias("jpg"), F.lit('{"md5": "broken"}').alias("json"), "source_shard", F.lit(99).cast("long").alias("source_index"))
    tiles = tiling.describe_images(images.unionByName(broken), o)
    assert tiles.where(F.col("error").isNotNull()).count() == 1
    got = tiling.local_select(images, o)
    assert got.columns == CANDIDATE and got.groupBy("sample_id").count().agg(F.max("count")).first()[0] <= 4


def test_incremental_run(spark, tmp_path):
    source, output = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(source)
    double = lambda df: df.select((F.col("id") * 2).alias("id"))
    schema = spark.range(1).schema
    assert incremental.run_incrementally(spark, source, schema, output, double, {"v": 1})["batches"] >= 1
    assert incremental.run_incrementally(spark, source, schema, output, double, {"v": 1})["batches"] == 0
    spark.range(5, 8).write.mode("append").parquet(source)
    incremental.run_incrementally(spark, source, schema, output, double, {"v": 1})
    assert sorted(r["id"] for r in incremental.results(spark, output).collect()) == [2 * k for k in range(8)]
    with pytest.raises(incremental.SignatureMismatch, match="does not match"):
        incremental.run_incrementally(spark, source, schema, output, double, {"v": 2})


def test_image_folders(spark, tmp_path):
    from siftwell.sources import images

    (tmp_path / "d" / "sub").mkdir(parents=True)
    for name in ("b.png", "sub/a.PNG", "note.txt"):
        (tmp_path / "d" / name).write_bytes(codec.encode_png(np.zeros((3, 5, 3), np.uint8)))
    (tmp_path / "d" / "broken.png").write_bytes(b"x")
    assert [r["path"].rsplit("/", 1)[1] for r in images.list_images(spark, str(tmp_path / "d"), 2).collect()] == ["b.png", "broken.png"]
    rows = images.read_images(spark, str(tmp_path / "d"))
    assert rows.count() == 3
    got = {r["path"]: (r["height"], r["width"], r["error"] is None) for r in images.sizes(rows).collect()}
    assert got == {"b.png": (3, 5, True), "a.PNG": (3, 5, True), "broken.png": (None, None, False)}


def test_stains():
    rgb = np.random.default_rng(0).integers(0, 256, (6, 6, 3)).astype(np.uint8)
    assert (raster.permute_channels(rgb, (2, 1, 0))[..., 0] == rgb[..., 2]).all()
    same = raster.stain_jitter(raster.stain_jitter(rgb, (0, 0), (1, 1)), (0, 0), (1, 1))
    assert np.abs(same.astype(int) - raster.stain_jitter(rgb, (0, 0), (1, 1))).max() <= 8
    with pytest.raises(ValueError):
        raster.permute_channels(rgb, (0, 0, 1))
