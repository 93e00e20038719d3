"""Queries that write something, read it back and can be told in SQL; and clusterings whose answer is plain.

Everything is written below the session's shared folder, under a new name each time. What the driver writes itself
has as many rows as there are nations.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from siftwell.config import SelectionOptions
from siftwell.operators import export, hierarchy, kmeans, selection
from siftwell.plans.catalog import PATCH_SQL, QUOTA_SQL, _edges, _patches, _points, query
from siftwell.session import read_table as table
from siftwell.sources import arrays, arrow_shards
from siftwell.tables import shared_folder


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"


def _sink(folder: str, name: str):
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    system.create_dir(root, recursive=True)
    return system.open_output_stream(f"{root}/{name}")


# ---- shards, matrices, hierarchies --------------------------------------------------------------


def _shards(spark, d) -> str:
    """The nations as records in one Arrow shard a region; the shards of odd regions are for testing."""
    rows = table(spark, d, "nation").orderBy("n_nationkey").select("n_nationkey", "n_regionkey", "n_name").collect()
    folder = _folder(spark)
    for region in sorted({r["n_regionkey"] for r in rows}):
        own = [r for r in rows if r["n_regionkey"] == region]
        pictures = [{"bytes": r["n_name"].encode() if r["n_nationkey"] % 7 else b"", "path": f"{r['n_nationkey']}.png"} for r in own]
        shard = pa.table({"jpg": pa.array(pictures, pa.struct([("bytes", pa.binary()), ("path", pa.string())])), "json": [f'{{"key": {r["n_nationkey"]}}}' for r in own]})
        with _sink(folder, f"{'test' if region % 2 else 'train'}-{region}.arrow") as sink, pa.ipc.new_stream(sink, shard.schema) as writer:
            writer.write_table(shard, max_chunksize=2)
    return folder


SHARD_SQL = """s AS (SELECT n_nationkey, n_name, n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS source_index,
  CASE WHEN n_regionkey % 2 = 1 THEN 'test-' ELSE 'train-' END || n_regionkey || '.arrow' AS shard FROM nation)"""


def _base(c: str):
    return F.regexp_extract(c, r"([^/]+)$", 1)


@query("shard_scan", "WITH " + SHARD_SQL + """ SELECT shard, source_index, CASE WHEN n_nationkey % 7 > 0 THEN n_name ELSE '' END AS body, n_nationkey || '.png' AS path, '{"key": ' || n_nationkey || '}' AS json FROM s""")
def shard_scan(spark, d):
    """All records of Arrow shards, with where they came from."""
    rows = arrow_shards.read_shards(spark, _shards(spark, d))
    return rows.select(_base("source_shard").alias("shard"), "source_index", F.decode("jpg.bytes", "UTF-8").alias("body"), "jpg.path", "json")


@query("shard_split", "WITH " + SHARD_SQL + " SELECT shard, source_index, n_name AS body FROM s WHERE shard LIKE 'test%' AND n_nationkey % 7 > 0")
def shard_split(spark, d):
    """The test shards' records that hold bytes."""
    rows = arrow_shards.with_bytes(arrow_shards.read_shards(spark, _shards(spark, d), "test"))
    return rows.select(_base("source_shard").alias("shard"), "source_index", F.decode("jpg.bytes", "UTF-8").alias("body"))


@query("manifest_images", "WITH " + SHARD_SQL + " SELECT shard, source_index, n_nationkey % 4 AS patch_index, CASE WHEN n_nationkey % 7 > 0 THEN n_name ELSE '' END AS body FROM s WHERE source_index < 4")
def manifest_images(spark, d):
    """Selected rows with their image's bytes, found by shard and place."""
    images = arrow_shards.read_shards(spark, _shards(spark, d))
    key = F.get_json_object("json", "$.key").cast("int")
    manifest = images.where(F.col("source_index") < 4).select(
        "source_shard", "source_index", (key % 4).alias("patch_index"), F.lit(0).alias("patch_x"), F.lit(0).alias("patch_y"), F.lit(16).alias("patch_size"), F.lit("s").alias("sample_slug"), F.lit("s").alias("sample_id"),
    )
    rows = export.crops(manifest, images)
    return rows.select(_base("source_shard").alias("shard"), "source_index", "patch_index", F.decode("bytes", "UTF-8").alias("body"))


@query("matrix_scan", "SELECT n_nationkey::BIGINT AS point_id, n_regionkey::DOUBLE AS region, n_nationkey / 2 AS half FROM nation WHERE n_nationkey % 2 = 0")
def matrix_scan(spark, d):
    """Rows of a stored matrix, dealt in ranges of 7, of which a list of ids takes some; nation keys count from 0."""
    rows = table(spark, d, "nation").orderBy("n_nationkey").collect()
    folder = _folder(spark)
    with _sink(folder, "points.npy") as sink:
        import io

        held = io.BytesIO()
        np.save(held, np.array([[r["n_regionkey"], r["n_nationkey"] / 2] for r in rows], np.float32))
        sink.write(held.getvalue())
    points = arrays.read_npy(spark, f"{folder.removeprefix('file://')}/points.npy", 7)
    kept = arrays.subset(points, table(spark, d, "nation").where(F.col("n_nationkey") % 2 == 0).select("n_nationkey"))
    return kept.select("point_id", F.col("embedding")[0].cast("double").alias("region"), F.col("embedding")[1].cast("double").alias("half"))


@query("reindexed_points", "SELECT 1000000 - vec_id AS point_id, len(embedding)::INT AS dims, round(embedding[1]::DOUBLE, 5) + 0.0 AS first FROM embeddings")
def reindexed_points(spark, d):
    """Points under new ids."""
    points = _points(spark, d).select("point_id", "embedding")
    ids = points.select((F.lit(1_000_000) - F.col("point_id")).alias("new_id"), "point_id")
    out = arrays.reindexed(points, ids)
    return out.select("point_id", F.size("embedding").alias("dims"), (F.round(F.col("embedding")[0].cast("double"), 5) + F.lit(0.0)).alias("first"))


@query(
    "stored_levels",
    """SELECT 1::INT AS level, c_nationkey::BIGINT AS cluster_id, c_custkey AS point_id FROM customer UNION ALL SELECT 2, n_regionkey, c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def stored_levels(spark, d):
    """A hierarchy written, read again and flattened."""
    path = _folder(spark)
    hierarchy.write_hierarchy(_edges(spark, d), path)
    return hierarchy.flatten(hierarchy.read_hierarchy(spark, path), 2)


# ---- manifests, names, totals -------------------------------------------------------------------


@query(
    "manifest_files",
    "WITH " + QUOTA_SQL.format(bins="o_orderstatus, o_orderpriority", table="orders", alpha=0.5, target=500)
    + " SELECT o_orderstatus, o_orderpriority, quota AS n, 1::BIGINT AS files FROM quotas WHERE quota > 0",
)
def manifest_files(spark, d):
    """A manifest's bins, read back: none is split between files."""
    bins = ("o_orderstatus", "o_orderpriority")
    chosen = selection.balanced_select(table(spark, d, "orders"), SelectionOptions(500, bins, 0.5, "o_totalprice", tie_columns=("o_orderkey",)))
    path = _folder(spark)
    export.write_manifest(chosen, path, list(bins))
    rows = spark.read.parquet(path).withColumn("file", F.input_file_name())
    return rows.groupBy(*bins).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files"))


@query(
    "embedded_names",
    """WITH t AS (SELECT source AS task_id, text, row_number() OVER (ORDER BY source NULLS FIRST, md5(text) NULLS FIRST) AS place FROM documents)
       SELECT coalesce(task_id, 'patches') || '_patch_' || CASE WHEN place < 10000 THEN lpad(place::VARCHAR, 5, '0') ELSE place::VARCHAR END || '.jpg' AS name, md5(text) AS body
       FROM t WHERE length(text) > 0""",
)
def embedded_names(spark, d):
    """File names of embedded bytes: the task and the place among all rows."""
    rows = table(spark, d, "documents").select(F.col("source").alias("task_id"), F.encode("text", "UTF-8").alias("image_bytes"))
    return export.embedded_names(rows).select("name", F.md5("bytes").alias("body"))


@query(
    "export_totals",
    "WITH " + PATCH_SQL + " SELECT count(DISTINCT source_shard) FILTER (patch_x < 900) AS shards, count(*) AS selected_rows, count(*) FILTER (patch_x < 900) AS written_members, count(*) FILTER (patch_x >= 900) AS missing_images FROM p",
)
def export_totals(spark, d):
    """Totals of an export over all shards, as its summary tells them."""
    from siftwell.files import read_text

    gone = F.col("patch_x") >= 900
    stats = _patches(spark, d).groupBy("source_shard").agg(F.count(F.lit(1)).alias("selected"), F.count_if(~gone).alias("written"), F.count_if(gone).alias("missing"))
    path = f"{_folder(spark)}/summary.json"
    export.export_summary(stats, path)
    told = F.from_json(F.lit(read_text(spark, path)), "shards long, selected_rows long, written_members long, missing_images long")
    return spark.range(1).select(told.alias("t")).select("t.*")


@query("incremental_rows", "SELECT n_nationkey, 2 * n_regionkey AS doubled FROM nation UNION ALL SELECT r_regionkey + 100, 2 * r_regionkey FROM region")
def incremental_rows(spark, d):
    """Two deliveries through an incremental run: each is worked on once, and a third call finds nothing new."""
    from siftwell.streaming.incremental import results, run_incrementally

    source, out = _folder(spark), _folder(spark)
    double = lambda rows: rows.select("n_nationkey", (2 * F.col("n_regionkey")).cast("int").alias("doubled"))
    nations = table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), F.col("n_regionkey").cast("int").alias("n_regionkey"))
    more = table(spark, d, "region").select((F.col("r_regionkey") + 100).cast("int").alias("n_nationkey"), F.col("r_regionkey").cast("int").alias("n_regionkey"))
    for part in (nations, more, None):
        if part is not None:
            part.write.mode("append").parquet(source)
        run_incrementally(spark, source, nations.schema, out, double, {"v": 1})
    return results(spark, out).select("n_nationkey", "doubled")


@query("image_formats", "SELECT n_nationkey, f AS format, (8 + n_nationkey)::INT AS height, (30 - n_nationkey)::INT AS width, true AS close FROM nation, (VALUES ('jpg'), ('png')) v(f)")
def image_formats(spark, d):
    """Plain images of every size, written and read in both formats."""

    def run(batches):
        from siftwell.sources import codec

        for batch in batches:
            out = []
            for k in batch.column("n_nationkey").to_pylist():
                rgb = np.full((8 + k, 30 - k, 3), (10 * k, 255 - 10 * k, 7 * k), np.uint8)
                for kind in ("jpg", "png"):
                    back = codec.decode(codec.encode(rgb, kind, 95))
                    out.append((k, kind, *back.shape[:2], bool(np.abs(back.astype(int) - rgb).max() <= (4 if kind == "jpg" else 0))))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.bool_())
            names = ["n_nationkey", "format", "height", "width", "close"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    rows = table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("n_nationkey"))
    return rows.mapInArrow(run, "n_nationkey int, format string, height int, width int, close boolean")


# ---- clusterings of well parted points ----------------------------------------------------------

#: Customers at places that part by region, two hemispheres of regions, and halves of a region.
PARTED_SQL = "r AS (SELECT c_custkey, n_regionkey AS region, c_custkey % 2 AS half FROM customer JOIN nation ON n_nationkey = c_nationkey)"


def _parted(spark, d):
    nations = table(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").alias("region"))
    rows = table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    x = 100 * F.col("region") + F.when(F.col("region") > 2, 10_000).otherwise(0) + (F.col("c_custkey") % 5) / 100
    return rows.select(F.col("c_custkey").alias("point_id"), F.array(x.cast("float"), (F.col("c_custkey") % 2).cast("float")).alias("embedding"), "region")


def _told(assigned):
    return assigned.groupBy("cluster_id").agg(F.min("point_id").alias("first"), F.max("point_id").alias("last"), F.count(F.lit(1)).alias("n")).drop("cluster_id")


GROUPS_SQL = "WITH " + PARTED_SQL + " SELECT min(c_custkey) AS first, max(c_custkey) AS last, count(*) AS n FROM r GROUP BY region"


@query("parted_kmeans", GROUPS_SQL)
def parted_kmeans(spark, d):
    """Greedy seeding and Lloyd rounds find groups that lie apart; the better of two runs stays."""
    return _told(kmeans.kmeans(_parted(spark, d), 5, 10, "kmeans++", 2, seed=4)[1])


@query("parted_kmeans_parallel", GROUPS_SQL)
def parted_kmeans_parallel(spark, d):
    """So does seeding by oversampled passes."""
    return _told(kmeans.kmeans(_parted(spark, d), 5, 10, "kmeans||", 2, seed=4)[1])


@query("parted_power_kmeans", GROUPS_SQL)
def parted_power_kmeans(spark, d):
    """And one-dimensional clusters under the fourth power."""
    values = _parted(spark, d).select("point_id", F.col("embedding")[0].alias("value"))
    return _told(kmeans.power_kmeans(values, 5, 2, 10)[1])


@query("parted_splits", "WITH " + PARTED_SQL + " SELECT region::BIGINT AS parent_id, min(c_custkey) AS first, max(c_custkey) AS last, count(*) AS n FROM r GROUP BY region, half")
def parted_splits(spark, d):
    """Every region parts into its halves."""
    rows = _parted(spark, d).select("point_id", "embedding", F.col("region").cast("long").alias("cluster_id"))
    parts = kmeans.split_clusters(rows, 2, 10, 4)
    return parts.groupBy("parent_id", "cluster_id").agg(F.min("point_id").alias("first"), F.max("point_id").alias("last"), F.count(F.lit(1)).alias("n")).drop("cluster_id")


@query(
    "parted_levels",
    "WITH " + PARTED_SQL + """ SELECT 1::INT AS level, min(c_custkey) AS first, max(c_custkey) AS last, count(*) AS n FROM r GROUP BY region
       UNION ALL SELECT 2, min(c_custkey), max(c_custkey), count(*) FROM r GROUP BY region > 2""",
)
def parted_levels(spark, d):
    """Regions, then hemispheres, with resampling of the lower level."""
    from siftwell.tables import settle

    edges, _ = hierarchy.hierarchical_kmeans(_parted(spark, d), [hierarchy.Level(5, 2), hierarchy.Level(2)], 10, "kmeans++", 2, resamples=1, seed=6)
    flat = hierarchy.flatten(settle(edges), 2)
    return flat.groupBy("level", "cluster_id").agg(F.min("point_id").alias("first"), F.max("point_id").alias("last"), F.count(F.lit(1)).alias("n")).drop("cluster_id")
