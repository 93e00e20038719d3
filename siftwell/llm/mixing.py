"""Mixing sources to target weights by capped water-filling. DataFrame operations only.

Sources ordered by code point (null last) weigh 3, 1, 2 and so on in turn and share ``share`` times all
words. A source takes at most ``max_epochs`` times its words; what it cannot take is shared again by
weight until no source stands above its cap. That fixed point is one level ``L`` with
``sum(min(cap, weight * L)) = total``, found with prefix sums over the sources ordered by cap / weight.

A source's target becomes whole repetitions of all its rows and, for the rest, the rows that come first
in a seeded order. The cut is found without gathering a source in one task: word totals per slice of the
order key locate the slice that holds the cut, and only that slice's rows are ordered. The row-level
decision then compares a row's own key with its source's cut, so texts are never shuffled.

Edge cases: null and empty texts have size 0 and take 0; a null source is a source of its own; rows that
repeat a doc_id within a source share one key and are taken together; an empty table gives no rows;
columns other than doc_id, text and source are neither read nor returned by ``mixed_sizes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm.support import WORD, order_key, settle, small

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 20240
#: Leading hexadecimal digits of the order key that make a slice: 4096 slices a source.
SLICE_DIGITS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target, whole, rest) from rows (source, size): one row a source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    slot = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (slot + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    filled = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("below", F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("above", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.coalesce("below", F.lit(0.0))) / F.col("above"))
        # the first source in this order that its level leaves below its cap sets the level of all after it
        .withColumn("nth", F.row_number().over(filled))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("nth", "level"))).over(everything)["level"])
        .withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return ranked.select(
        "source", "source_size", "target", whole.cast("long").alias("whole")
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))


def source_cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``cut``: rows whose key is not above it are taken once more.

    ``sizes`` has (source, size, key). A row counts as taken if its middle lies below the rest.
    """
    slices = sizes.groupBy("source", F.substring("key", 1, SLICE_DIGITS).alias("slice")).agg(F.sum("size").alias("size"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    goals = targets.select(F.col("source").alias("s"), "rest")
    edge = (
        slices.join(goals, F.col("source").eqNullSafe(F.col("s")))
        .where(F.col("before") <= F.col("rest"))
        .groupBy("source")
        .agg(F.max(F.struct("slice", "before", "rest")).alias("e"))
        .select("source", "e.*")
    )
    edge = small(settle(edge))
    edge = edge.select(F.col("source").alias("edge_source"), F.col("slice").alias("edge_slice"), "before", "rest")
    rows = sizes.withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
    inside = (
        rows.join(edge, F.col("source").eqNullSafe(F.col("edge_source")) & (F.col("slice") == F.col("edge_slice")))
        .groupBy("source", "key", "before", "rest")
        .agg(F.sum("size").alias("size"))
    )
    run = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    last = (
        inside.where(2 * F.col("ahead") + F.col("size") <= 2 * F.col("rest"))
        .groupBy("source")
        .agg(F.max("key").alias("last_key"))
        .select(F.col("source").alias("last_source"), "last_key")
    )
    cuts = edge.join(last, F.col("edge_source").eqNullSafe(F.col("last_source")), "left").select(
        F.col("edge_source").alias("s"), F.coalesce("last_key", "edge_slice").alias("cut")
    )
    return targets.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def _sizes(docs: DataFrame, seed: int) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), order_key(seed, "doc_id").alias("key"))


def _plan(sizes: DataFrame, weights, share, max_epochs) -> DataFrame:
    targets = settle(source_targets(sizes, weights, share, max_epochs))
    return settle(source_cuts(sizes, targets))


def _repeats(max_epochs: int):
    more = F.coalesce(F.col("key") <= F.col("cut"), F.lit(False)) & (F.col("whole") < max_epochs)
    return F.col("whole") + more.cast("long")


def mixed_sizes(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS, seed=SEED) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken and repeats."""
    sizes = settle(_sizes(docs, seed))
    plan = _plan(sizes, weights, share, max_epochs).withColumnRenamed("source", "plan_source")
    joined = sizes.join(small(plan), F.col("source").eqNullSafe(F.col("plan_source")))
    return joined.withColumn("repeats", _repeats(max_epochs)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"), "repeats", "source"
    )


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS, seed=SEED) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as the plan takes it, with the columns of ``docs``."""
    plan = _plan(settle(_sizes(docs, seed)), weights, share, max_epochs)
    plan = plan.select(F.col("source").alias("mix_source"), "cut", "whole")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), order_key(seed, "doc_id").alias("key"), F.col("source").alias("own_source"))
    joined = rows.join(small(plan), F.col("own_source").eqNullSafe(F.col("mix_source")))
    copies = F.explode(F.array_repeat(F.lit(1), _repeats(max_epochs).cast("int")))
    return joined.select("row", copies.alias("copy")).select("row.*")


SQL = """
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('20240:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
             source_size * 2.0::DOUBLE AS cap FROM totals),
r AS (SELECT *, cap / weight AS ratio, (SELECT sum(source_size) FROM totals)::DOUBLE * 1.5::DOUBLE AS total FROM w),
f AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
             row_number() OVER (ORDER BY ratio, source NULLS LAST) AS nth FROM r),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, nth) FROM f WHERE level <= ratio) * weight, cap)) AS target FROM f),
g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
run AS (SELECT s.*, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS rest,
               coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
        FROM sizes s JOIN g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN whole < 2 AND 2 * ahead + size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""
