"""The commands, end to end on a few synthetic images."""

import pyarrow as pa
import pytest

from siftwell import benchmarks
from siftwell.cli import main
from siftwell.operators.hierarchy import write_hierarchy
from siftwell.sources.arrays import synthetic_images


@pytest.fixture(scope="module")
def shards(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shards")
    rows = synthetic_images(spark, 6, 64).collect()
    for shard in sorted({r["source_shard"] for r in rows}):
        own = [r for r in rows if r["source_shard"] == shard]
        table = pa.table({"jpg": pa.array([{"bytes": bytes(r["jpg"]["bytes"]), "path": r["jpg"]["path"]} for r in own], pa.struct([("bytes", pa.binary()), ("path", pa.string())])), "json": pa.array([r["json"] for r in own])})
        with pa.OSFile(str(folder / shard), "wb") as sink, pa.ipc.new_file(sink, table.schema) as writer:
            writer.write_table(table)
    return folder


def test_commands(spark, shards, tmp_path):
    local = ["local-select", "--data_dir", str(shards), "--output_dir", f"{tmp_path}/l", "--patch_size", "32", "--magnification_factors", "1.0", "--keep_ratio", "0.5"]
    first = main(local, spark)
    assert first["images"] == first["usable"] == 6 and first["selected"] > 0
    assert main(local, spark) == first
    with pytest.raises(RuntimeError, match="does not match"):
        main([*local, "--keep_max", "2"], spark)
    told = main(["global-select", "--candidate_dir", f"{tmp_path}/l/candidates", "--output_dir", f"{tmp_path}/g", "--target_size", "5"], spark)
    assert told["selected_rows"] == 5
    told = main(["pack-tars", "--manifest_dir", f"{tmp_path}/g", "--data_dir", str(shards), "--output_dir", f"{tmp_path}/t"], spark)
    assert told["written_members"] == 5 and told["missing_images"] == 0
    assert main(["export-images", "--data_dir", str(shards), "--output_dir", f"{tmp_path}/i", "--limit", "3"], spark)["exported"] == 3


def test_sample_command(spark, tmp_path):
    edges = spark.createDataFrame([(1, c, 10 * c + k, k + 1) for c in range(3) for k in range(4)], "level int, cluster_id long, child_id long, rank int")
    write_hierarchy(edges, f"{tmp_path}/h")
    told = main(["sample", "--hierarchy", f"{tmp_path}/h", "--output_dir", f"{tmp_path}/s", "--target_size", "7", "--strategy", "c", "--sort"], spark)
    assert told["sampled"] == 7 and told["path"].endswith("1c_mul1_7_balanced_selection")


def test_benchmark(spark):
    runs = main(["benchmark", "--limit", "4", "--size", "64", "--workers", "1,2"], spark)["runs"]
    assert [r["workers"] for r in runs] == [1, 2]
    rows = [("a", 1, 2.0), ("a", 2, 3.0), ("b", 2, 6.0)]
    got = benchmarks.summarize(spark.createDataFrame(rows, "backend string, workers int, images_per_second double")).collect()
    assert {r["backend"]: (r["best_workers"], r["speedup"]) for r in got} == {"a": (2, 1.0), "b": (2, 2.0)}
