"""Sharding by proportional stratified interleaving. DataFrame operations only.

Rows get a seeded shuffle rank within their source, the ranks become fractions of the source, and all
rows in order of their fraction are cut into equal runs, so each shard holds every source in its share.
The law that holds is ``rows``: shards differ by at most one row. Equal texts are ordinary rows here:
they are dealt like any others, since keeping a large group together would break the law.

No source and no shard is ordered in one task. A rank is the count of rows in earlier slices of the
shuffle key plus the row number within the slice; a position is the count of rows in earlier ranges of
the fraction plus the row number within the range.

Edge cases: a null or empty text has size 1 and the checksum 0; a null source is a source of its own;
repeated rows are ordered by checksum and size, and identical ones are interchangeable; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm.support import order_key, settle

SHARDS = 16
SEED = 7121
SLICE_DIGITS = 3
#: Rows that one range of the fraction should hold.
RANGE_ROWS = 20_000


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``."""
    key = order_key(seed, "doc_id")
    ids = docs.select("source", F.substring(key, 1, SLICE_DIGITS).alias("slice"))
    slices = ids.groupBy("source", "slice").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("source").orderBy("slice")
    slices = slices.select(
        F.col("source").alias("slice_source"),
        F.col("slice").alias("slice_key"),
        (F.sum("n").over(upto) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("source")).alias("in_source"),
    )
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        "source",
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        key.alias("key"),
    ).withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
    ties = ["key", "doc_id", "text_crc32", "size"]
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("source", "slice").orderBy(*ties)))
    ranked = ranked.join(
        slices, F.col("source").eqNullSafe(F.col("slice_source")) & (F.col("slice") == F.col("slice_key"))
    ).withColumn("fraction", (2 * (F.col("before") + F.col("nth")) - 1) / (2.0 * F.col("in_source")))
    total = docs.count()
    ranges = max(64, total // RANGE_ROWS)
    ranked = settle(
        ranked.select("doc_id", "source", "size", "text_crc32", "key", "fraction").withColumn(
            "range", F.floor(F.col("fraction") * ranges).cast("int")
        )
    )
    counts = ranked.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(
        F.col("range").alias("r"), (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("offset")
    )
    within = Window.partitionBy("range").orderBy("fraction", F.col("source").asc_nulls_last(), *ties)
    placed = ranked.withColumn("nth", F.row_number().over(within)).join(counts, F.col("range") == F.col("r"))
    # whole-number arithmetic: the cut must not round
    position = (F.col("offset") + F.col("nth") - 1).cast("long")
    placed = placed.withColumn("position", position).withColumn(
        "shard", F.expr(f"(position * {shards}L) div {max(total, 1)}L").cast("int")
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.expr(f"position - (shard * {total}L + {shards - 1}L) div {shards}L").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def _crc_steps() -> list[int]:
    """What four bits of a checksum become in one step of the reflected CRC-32."""
    table = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    return table


SQL = f"""
WITH d AS (
  SELECT source, doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, string_split(hex(encode(coalesce(text, ''))), '') AS digits,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
n AS (SELECT *, CASE WHEN size = 1 THEN [] ELSE list_transform(range(0, len(digits)), lambda i: CAST(strpos('0123456789ABCDEF', digits[xor(i, 1) + 1]) - 1 AS BIGINT)) END AS nibbles FROM d),
c AS (SELECT source, doc_id, size, k,
             xor(list_reduce(list_prepend(4294967295, nibbles), lambda a, x: xor(a >> 4, {_crc_steps()}[(xor(a, x) & 15) + 1])), 4294967295) AS crc FROM n),
r AS (SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY k, doc_id, crc, size) - 1) / (2.0::DOUBLE * count(*) OVER (PARTITION BY source)) AS fraction FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, source NULLS LAST, k, doc_id, crc, size) - 1 AS position, count(*) OVER () AS total FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(position * {SHARDS} // total AS INTEGER) AS shard,
       CAST(position - ((position * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""
