"""Registered queries over the driver's tables, with their oracle SQL.

Documents and orders stand in for candidates, (lang, source) and (status, priority) for bins, label quality
for a nullable bin, embedding labels for clusters, and region, nation, customer for a hierarchy.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from siftwell.config import PatchOptions, SelectionOptions
from siftwell.functions import stats, text, tiles, vectors
from siftwell.operators import coreset, hierarchy, kmeans, neighbors, sampling, scores, selection, tiling
from siftwell.schemas import BASE_FEATURES, SEMANTIC_FEATURES
from siftwell.session import read_table as table
from siftwell.sources.arrays import rings, synthetic_images

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its oracle where SQL can tell."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


# ---- bins, quotas, budgeted selection -----------------------------------------------------------


@query("bin_counts", "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def bin_counts(spark, d):
    return selection.bin_counts(table(spark, d, "documents"), ("lang", "source"))


@query(
    "bin_counts_nulls",
    "SELECT d.lang, l.quality::VARCHAR AS quality, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.lang, l.quality",
)
def bin_counts_nulls(spark, d):
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("labelled"), "quality")
    docs = table(spark, d, "documents")
    counts = selection.bin_counts(docs.join(labels, F.col("doc_id") == F.col("labelled"), "left"), ("lang", "quality"))
    return counts.withColumn("quality", F.col("quality").cast("string"))


@query("global_bin", "SELECT count(*) AS n FROM documents")
def global_bin(spark, d):
    return selection.bin_counts(table(spark, d, "documents"), ())


@query(
    "bin_values",
    """SELECT coalesce(nullif(CASE WHEN user_id % 5 = 0 THEN '' WHEN user_id % 5 = 1 THEN NULL ELSE event_type END, ''), '') AS kind,
              CASE WHEN event_id % 7 IN (0, 1) THEN NULL ELSE (event_id % 3)::DOUBLE END AS grade, count(*) AS n FROM events GROUP BY 1, 2""",
)
def bin_values(spark, d):
    """Null, NaN and empty text fall into one bin."""
    e = table(spark, d, "events").select(
        F.when(F.col("user_id") % 5 == 0, "").when(F.col("user_id") % 5 != 1, F.col("event_type")).alias("kind"),
        F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).when(F.col("event_id") % 7 != 1, (F.col("event_id") % 3).cast("double")).alias("grade"),
    )
    return selection.bin_counts(e, ("kind", "grade"))


QUOTA_SQL = """
c AS (SELECT {bins}, count(*) AS n FROM {table} GROUP BY {bins}),
w AS (SELECT *, pow(n::DOUBLE, {alpha}) AS weight FROM c),
s AS (SELECT *, {target} * weight / sum(weight) OVER () AS share FROM w),
q AS (SELECT *, least(floor(share)::BIGINT, n) AS quota0 FROM s),
r AS (SELECT *, {target} - sum(quota0) OVER () AS rest,
             sum(CASE WHEN quota0 < n THEN 1 ELSE 0 END) OVER (ORDER BY round(share - floor(share), 9) DESC, {bins}) AS nth FROM q),
quotas AS (SELECT {bins}, n, (quota0 + CASE WHEN quota0 < n AND nth <= rest THEN 1 ELSE 0 END)::BIGINT AS quota FROM r)"""


@query("tempered_quotas", "WITH " + QUOTA_SQL.format(bins="lang, source", table="documents", alpha=0.5, target=100) + " SELECT lang, source, n, quota FROM quotas")
def tempered_quotas(spark, d):
    columns = ("lang", "source")
    counts = selection.bin_counts(table(spark, d, "documents"), columns)
    quotas = selection.quota_table(counts, columns, SelectionOptions(100, columns, 0.5))
    return counts.join(quotas, list(columns)).select("lang", "source", "n", F.col("quota").cast("long").alias("quota"))


@query("distributed_quotas", "WITH " + QUOTA_SQL.format(bins="lang, source", table="documents", alpha=0.5, target=100) + " SELECT lang, source, n, quota FROM quotas")
def distributed_quotas(spark, d):
    columns = ("lang", "source")
    counts = selection.bin_counts(table(spark, d, "documents"), columns)
    return selection.distributed_quotas(counts, columns, SelectionOptions(100, columns, 0.5)).select("lang", "source", "n", F.col("quota").cast("long").alias("quota"))


@query(
    "balanced_selection",
    "WITH " + QUOTA_SQL.format(bins="lang, source", table="documents", alpha=0.5, target=100)
    + """, k AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, q.quota, row_number() OVER (PARTITION BY d.lang, d.source ORDER BY d.n_chars DESC, d.doc_id) AS rank
         FROM documents d JOIN quotas q ON d.lang IS NOT DISTINCT FROM q.lang AND d.source IS NOT DISTINCT FROM q.source)
       SELECT doc_id, lang, source, n_chars FROM k WHERE rank <= quota""",
)
def balanced_selection(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return selection.balanced_select(docs, SelectionOptions(100, ("lang", "source"), 0.5, "n_chars", tie_columns=("doc_id",)))


@query(
    "balanced_orders",
    "WITH " + QUOTA_SQL.format(bins="o_orderstatus, o_orderpriority", table="orders", alpha=0.5, target=500)
    + """, k AS (SELECT o.*, q.quota, row_number() OVER (PARTITION BY o.o_orderstatus, o.o_orderpriority ORDER BY o.o_totalprice DESC, o.o_orderkey) AS rank
         FROM orders o JOIN quotas q USING (o_orderstatus, o_orderpriority))
       SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM k WHERE rank <= quota""",
)
def balanced_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return selection.balanced_select(
        orders, SelectionOptions(500, ("o_orderstatus", "o_orderpriority"), 0.5, "o_totalprice", tie_columns=("o_orderkey",))
    )


@query(
    "topk_per_bin",
    """SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_extendedprice, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber)::INT AS rank FROM lineitem)
       WHERE rank <= 25""",
)
def topk_per_bin(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_extendedprice")
    return selection.top_per_bin(rows, ("l_returnflag", "l_linestatus"), "l_extendedprice", 25, ["l_orderkey", "l_linenumber"])


@query(
    "nan_backfill",
    """WITH v AS (SELECT event_id, event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS score FROM events),
       c AS (SELECT event_type, count(*) AS n FROM v GROUP BY event_type),
       k AS (SELECT v.*, (c.n * 4) // 5 AS quota, row_number() OVER (PARTITION BY v.event_type ORDER BY v.score IS NULL, v.score DESC, v.event_id) AS rank FROM v JOIN c USING (event_type))
       SELECT event_id, event_type, score FROM k WHERE rank <= quota""",
)
def nan_backfill(spark, d):
    """Rows without a finite score come last and still fill a quota."""
    events = table(spark, d, "events")
    score = F.when(F.col("event_id") % 3 == 0, F.when(F.col("event_id") % 2 == 0, F.lit(float("nan")))).otherwise(F.col("value"))
    rows = events.select("event_id", "event_type", score.alias("score"))
    quota = lambda counts: counts.select("event_type", F.expr("n * 4 div 5").alias("quota"))
    best = selection.best_of_bins(rows, ("event_type",), "score", ["event_id"], quota)
    return best.withColumn("score", F.when(~F.isnan("score"), F.col("score")))


# ---- statistics ---------------------------------------------------------------------------------


@query(
    "zscore_by_group",
    """SELECT event_id, event_type, round(CASE WHEN stddev_pop(value) OVER w < 1e-6 THEN 0 ELSE (value - avg(value) OVER w) / stddev_pop(value) OVER w END, 6) AS z
       FROM events WINDOW w AS (PARTITION BY event_type)""",
)
def zscore_by_group(spark, d):
    return table(spark, d, "events").select("event_id", "event_type", F.round(stats.zscore(F.col("value"), "event_type"), 6).alias("z"))


@query(
    "robust_scale_by_group",
    """WITH m AS (SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS qm, quantile_cont(l_extendedprice, 0.5) AS pm, stddev_pop(l_quantity) AS qs, stddev_pop(l_extendedprice) AS ps FROM lineitem GROUP BY 1),
       c AS (SELECT l.*, m.* EXCLUDE (l_returnflag), l_quantity - qm AS qd, l_extendedprice - pm AS pd FROM lineitem l JOIN m USING (l_returnflag)),
       a AS (SELECT l_returnflag, quantile_cont(abs(qd), 0.5) AS qa, quantile_cont(abs(pd), 0.5) AS pa FROM c GROUP BY 1)
       SELECT l_orderkey, l_linenumber, round(qd / CASE WHEN qa > 1e-6 THEN 1.4826 * qa WHEN qs > 1e-6 THEN qs ELSE 1 END, 6) AS quantity,
              round(pd / CASE WHEN pa > 1e-6 THEN 1.4826 * pa WHEN ps > 1e-6 THEN ps ELSE 1 END, 6) AS price FROM c JOIN a USING (l_returnflag)""",
)
def robust_scale_by_group(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice")
    out = stats.robust_scale(rows, ["l_quantity", "l_extendedprice"], ["l_returnflag"])
    return out.select("l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("quantity"), F.round("l_extendedprice", 6).alias("price"))


@query(
    "quantile_summary",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 4) AS q10, round(quantile_cont(l_extendedprice, 0.5), 4) AS q50,
              round(quantile_cont(l_extendedprice, 0.9), 4) AS q90, coalesce(quantile_cont(l_extendedprice, 0.5) FILTER (l_quantity < 0), 1.0) AS none
       FROM lineitem GROUP BY l_returnflag""",
)
def quantile_summary(spark, d):
    price = F.col("l_extendedprice")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        *[F.round(stats.quantile(price, p), 4).alias(n) for n, p in (("q10", 0.1), ("q50", 0.5), ("q90", 0.9))],
        stats.quantile(F.when(F.col("l_quantity") < 0, price), 0.5, 1.0).alias("none"),
    )


@query(
    "histogram4",
    """WITH e AS (SELECT event_type, value / 100 AS v FROM events),
       b AS (SELECT event_type, v, CASE WHEN v BETWEEN 0 AND 1 THEN least(floor(v * 4), 3) END AS k FROM e)
       SELECT event_type, coalesce(count(*) FILTER (k = 0) / nullif(count(k), 0), 0)::DOUBLE AS bin0, coalesce(count(*) FILTER (k = 1) / nullif(count(k), 0), 0)::DOUBLE AS bin1,
              coalesce(count(*) FILTER (k = 2) / nullif(count(k), 0), 0)::DOUBLE AS bin2, coalesce(count(*) FILTER (k = 3) / nullif(count(k), 0), 0)::DOUBLE AS bin3 FROM b GROUP BY event_type""",
)
def histogram4(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(*stats.histogram4(F.col("value") / 100))


@query(
    "mean_and_deviation",
    """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean, round(stddev_pop(o_totalprice), 4) AS deviation,
              coalesce(avg(o_totalprice) FILTER (o_totalprice < 0), 0)::DOUBLE AS empty_mean, coalesce(stddev_pop(o_totalprice) FILTER (o_totalprice < 0), 0)::DOUBLE AS empty_deviation
       FROM orders GROUP BY o_orderpriority""",
)
def mean_and_deviation(spark, d):
    price = F.col("o_totalprice")
    none = F.when(price < 0, price)
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.round(stats.safe_mean(price), 4).alias("mean"), F.round(stats.safe_std(price), 4).alias("deviation"),
        stats.safe_mean(none).alias("empty_mean"), stats.safe_std(none).alias("empty_deviation"),
    )


@query(
    "log_variance",
    "SELECT l_returnflag, round(ln(var_pop(l_discount) + 1e-6), 6) AS log_var FROM lineitem GROUP BY l_returnflag",
)
def log_variance(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.log(F.var_pop("l_discount") + 1e-6), 6).alias("log_var"))


@query(
    "best_worker",
    """WITH t AS (SELECT event_type AS backend, user_id % 8 + 1 AS workers, round(sum(value), 6) AS rate FROM events GROUP BY 1, 2),
       b AS (SELECT backend, arg_max(workers, (rate, -workers)) AS best_workers, max(rate) AS best_rate FROM t GROUP BY backend)
       SELECT b.backend, b.best_workers, round(b.best_rate, 4) AS best_rate, round(b.best_rate / o.rate, 4) AS speedup
       FROM b JOIN t o ON o.backend = (SELECT min(backend) FROM t) AND o.workers = b.best_workers""",
)
def best_worker(spark, d):
    """The worker count with the best rate of each backend, and its speedup over the first backend."""
    rates = table(spark, d, "events").groupBy(F.col("event_type").alias("backend"), (F.col("user_id") % 8 + 1).alias("workers")).agg(F.round(F.sum("value"), 6).alias("rate"))
    best = rates.groupBy("backend").agg(F.max_by(F.struct("workers", "rate"), F.struct("rate", -F.col("workers"))).alias("b"))
    base = rates.groupBy("workers").agg(F.min_by("rate", "backend").alias("base"), F.min("backend").alias("base_backend"))
    first = rates.agg(F.min("backend").alias("first"))
    base = base.join(F.broadcast(first), F.col("base_backend") == F.col("first")).select(F.col("workers").alias("w"), "base")
    return best.join(base, F.col("b.workers") == F.col("w")).select(
        "backend", F.col("b.workers").alias("best_workers"), F.round("b.rate", 4).alias("best_rate"), F.round(F.col("b.rate") / F.col("base"), 4).alias("speedup")
    )


@query(
    "run_summary",
    """SELECT count(*) AS processed, count(*) FILTER (text IS NULL OR length(text) = 0) AS skipped, count(DISTINCT source) AS parts,
              CAST(sum(n_chars) AS BIGINT) AS chars FROM documents""",
)
def run_summary(spark, d):
    return table(spark, d, "documents").agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(F.col("text").isNull() | (F.length("text") == 0)).alias("skipped"),
        F.count_distinct("source").alias("parts"), F.sum("n_chars").alias("chars"),
    )


@query(
    "kde_divergence",
    """WITH v AS (SELECT value / 100 AS x FROM events),
       g AS (SELECT (i + 0.5) / 50 AS spot FROM range(50) t(i)),
       k AS (SELECT spot, sum(exp(-((spot - x) / 0.1) * ((spot - x) / 0.1) / 2)) AS mass FROM g, v GROUP BY spot),
       p AS (SELECT mass / sum(mass) OVER () AS p FROM k)
       SELECT round(sum(p * ln(p * 50)), 5) AS divergence FROM p""",
)
def kde_divergence(spark, d):
    """How far a kernel density is from uniform: one pass with a sum for each of 50 places, so no row is repeated."""
    x = F.col("value") / 100
    gap = [(F.lit((i + 0.5) / 50) - x) / 0.1 for i in range(50)]
    sums = table(spark, d, "events").agg(*[F.sum(F.exp(-g * g / 2)).alias(f"m{i}") for i, g in enumerate(gap)])
    mass = sums.select(F.array(*[F.col(f"m{i}") for i in range(50)]).alias("mass"))
    add = lambda v: F.aggregate(v, F.lit(0.0), lambda a, b: a + b)
    share = mass.select(F.transform("mass", lambda m: m / add(F.col("mass"))).alias("p"))
    return share.select(F.round(add(F.transform("p", lambda p: p * F.log(p * 50))), 5).alias("divergence"))


# ---- text, metadata, names ----------------------------------------------------------------------


@query(
    "slugs",
    """SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(replace(lower(p_name), '&', ' and '), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'none') AS slug,
              coalesce(nullif(regexp_replace(regexp_replace(replace(lower(p_brand || ' & ' || p_type), '&', ' and '), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'none') AS kind FROM part""",
)
def slugs(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", text.slugify(F.col("p_name"), "none").alias("slug"), text.slugify(F.concat_ws(" & ", "p_brand", "p_type"), "none").alias("kind")
    )


@query(
    "json_metadata",
    """SELECT event_id, props->>'$.k' AS k, len(json_keys(props)) AS fields FROM events""",
)
def json_metadata(spark, d):
    m = text.custom_metadata(F.col("props"))
    return table(spark, d, "events").select("event_id", m["k"].alias("k"), F.size(m).cast("long").alias("fields"))


@query(
    "nested_metadata",
    """SELECT event_id, props->>'$.k' AS gene, CASE WHEN event_id % 4 = 0 THEN 'liver' ELSE '' END AS tissue,
              (CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN 0 ELSE CASE WHEN event_id % 5 = 0 THEN 1 END END)::VARCHAR AS is_cancer FROM events""",
)
def nested_metadata(spark, d):
    """Aliases, nested and doubly encoded metadata, and malignancy told by key or by text."""
    k = F.get_json_object("props", "$.k")
    inner = F.to_json(
        F.struct(
            F.lit("").alias("gene"), k.alias("marker"), F.when(F.col("event_id") % 4 == 0, "liver").alias("organ"),
            F.when(F.col("event_id") % 3 == 0, "Malignant").when(F.col("event_id") % 3 == 1, "0").alias("malignancy"),
            F.when(F.col("event_id") % 5 == 0, "Adenocarcinoma of x").otherwise("fine").alias("title"), F.lit("1 2").alias("rle_mask"),
        )
    )
    record = F.to_json(F.struct(inner.alias("custom_metadata")))
    m = text.normalize_metadata(text.without_large_fields(text.custom_metadata(record)))
    return table(spark, d, "events").select("event_id", m["gene"].alias("gene"), m["tissue"].alias("tissue"), m["is_cancer"].cast("string").alias("is_cancer"))


@query(
    "rle_runs",
    """SELECT l_orderkey, l_linenumber, (CASE WHEN l_linenumber % 3 <> 0 THEN l_partkey - 1 END)::VARCHAR AS start, (CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity::BIGINT END)::VARCHAR AS len FROM lineitem""",
)
def rle_runs(spark, d):
    """Mask texts as runs; a text with an odd count of numbers is none."""
    told = F.concat_ws(" ", F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity").cast("long").cast("string")))
    run = text.rle_runs(told)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", run[0]["start"].cast("string").alias("start"), run[0]["len"].cast("string").alias("len"))


@query(
    "rle_overlap",
    """WITH r AS (SELECT p_partkey, p_partkey % 37 AS s, p_partkey % 37 + p_size AS e FROM part),
       t AS (SELECT p_partkey, i * 16 AS a, i * 16 + 16 AS b, s, e, i FROM r, range(4) x(i))
       SELECT p_partkey, i::INT AS tile, greatest(0, least(b, e) - greatest(a, s))::BIGINT AS overlap FROM t""",
)
def rle_overlap(spark, d):
    """Pixels of each run inside each tile of a column."""
    runs = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 37).alias("s"), (F.col("p_partkey") % 37 + F.col("p_size")).alias("e"))
    tiled = runs.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(3))))
    a = F.col("tile") * 16
    return tiled.select("p_partkey", "tile", F.greatest(F.lit(0), F.least(a + 16, F.col("e")) - F.greatest(a, F.col("s"))).cast("long").alias("overlap"))


@query(
    "sample_ids",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN md5(source) ELSE 'shard-' || (doc_id % 7) || ':' || doc_id END AS sample_id FROM documents""",
)
def sample_ids(spark, d):
    shard = F.concat(F.lit("/data/shard-"), (F.col("doc_id") % 7).cast("string"), F.lit(".arrow"))
    known = F.when(F.col("doc_id") % 3 == 0, F.md5("source")).otherwise("")
    return table(spark, d, "documents").select("doc_id", text.sample_id(known, shard, F.col("doc_id")).alias("sample_id"))


def _patches(spark, d):
    shard = F.concat(F.lit("/data/Part "), (F.col("l_suppkey") % 5).cast("string"), F.lit(".arrow"))
    return table(spark, d, "lineitem").select(
        shard.alias("source_shard"), F.col("l_orderkey").alias("source_index"), F.col("l_linenumber").alias("patch_index"),
        F.concat(F.lit("S "), F.col("l_partkey").cast("string")).alias("sample_slug"), F.lit("x").alias("sample_id"),
        (F.col("l_partkey") % 1000).alias("patch_x"), (F.col("l_suppkey") % 1000).alias("patch_y"), (F.col("l_linenumber") % 3).alias("scale_level"),
    )


PATCH_SQL = """p AS (SELECT '/data/Part ' || (l_suppkey % 5) || '.arrow' AS source_shard, 'part_' || (l_suppkey % 5) AS stem, l_orderkey AS source_index, l_linenumber AS patch_index,
  l_partkey AS s, l_partkey % 1000 AS patch_x, l_suppkey % 1000 AS patch_y, l_linenumber % 3 AS scale_level FROM lineitem)"""


@query(
    "tar_members",
    "WITH " + PATCH_SQL + """ SELECT source_index, patch_index, 's_' || s || '__i' || lpad(source_index::VARCHAR, 7, '0') || '__p' || lpad(patch_index::VARCHAR, 4, '0') || '__m' || lpad(scale_level::VARCHAR, 2, '0')
       || '__x' || lpad(patch_x::VARCHAR, 5, '0') || '__y' || lpad(patch_y::VARCHAR, 5, '0') || '.png' AS member,
       stem || '_' || substr(md5(source_shard), 1, 10) || '_part' || lpad(((row_number() OVER (PARTITION BY source_shard ORDER BY source_index, patch_index, patch_y, patch_x) - 1) // 1000)::VARCHAR, 6, '0') || '.tar' AS tar FROM p""",
)
def tar_members(spark, d):
    """Archive and member names of patches, in chunks of 1000 a shard."""
    rows = _patches(spark, d)
    order = Window.partitionBy("source_shard").orderBy("source_index", "patch_index", "patch_y", "patch_x")
    chunk = F.floor((F.row_number().over(order) - 1) / 1000)
    return rows.select(
        "source_index", "patch_index", text.member_name("png", F.col("scale_level")).alias("member"), text.tar_name(F.col("source_shard"), "none", chunk).alias("tar")
    )


@query(
    "shard_summary",
    "WITH " + PATCH_SQL + " SELECT source_shard, count(*) AS selected, count(*) FILTER (patch_x < 900) AS written, count(*) FILTER (patch_x >= 900) AS missing FROM p GROUP BY source_shard",
)
def shard_summary(spark, d):
    written = F.col("patch_x") < 900
    return _patches(spark, d).groupBy("source_shard").agg(F.count(F.lit(1)).alias("selected"), F.count_if(written).alias("written"), F.count_if(~written).alias("missing"))


@query(
    "collision_names",
    """SELECT p_partkey, lower(p_brand) || CASE WHEN n > 1 THEN '_' || n ELSE '' END || '.jpg' AS name FROM (SELECT p_partkey, replace(p_brand, '#', '_') AS p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part)""",
)
def collision_names(spark, d):
    """Repeated output names get a number."""
    rows = table(spark, d, "part").withColumn("n", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")))
    more = F.when(F.col("n") > 1, F.concat(F.lit("_"), F.col("n").cast("string"))).otherwise("")
    return rows.select("p_partkey", F.concat(text.slugify(F.col("p_brand"), "x"), more, F.lit(".jpg")).alias("name"))


@query(
    "split_and_subset",
    """SELECT d.doc_id, d.source FROM documents d WHERE d.source LIKE 'src1%' AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def split_and_subset(spark, d):
    """Split pruning by name and a subset by listed ids, both before anything is read in full."""
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("listed"))
    docs = table(spark, d, "documents").where(F.col("source").startswith("src1")).select("doc_id", "source")
    return docs.join(labels, F.col("doc_id") == F.col("listed"), "left_semi")


@query(
    "shard_lookup",
    """SELECT n_nationkey, r_name AS found FROM nation n LEFT JOIN region r ON lower(r_name) = lower(CASE WHEN n_nationkey % 2 = 0 THEN (SELECT r_name FROM region x WHERE x.r_regionkey = n.n_regionkey) ELSE 'none' END)""",
)
def shard_lookup(spark, d):
    """Names found again whatever their case."""
    region = table(spark, d, "region")
    nation = table(spark, d, "nation").join(region.select(F.col("r_regionkey").alias("k"), F.upper("r_name").alias("up")), F.col("n_regionkey") == F.col("k"))
    asked = nation.select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("up")).otherwise("none").alias("asked"))
    return asked.join(region, F.lower("asked") == F.lower("r_name"), "left").select("n_nationkey", F.col("r_name").alias("found"))


@query("export_limit", "SELECT doc_id, n_chars FROM documents WHERE n_chars > 0 ORDER BY doc_id LIMIT 50")
def export_limit(spark, d):
    """The first rows that hold bytes: a limit that counts what is exported."""
    return table(spark, d, "documents").where(F.col("n_chars") > 0).select("doc_id", "n_chars").orderBy("doc_id").limit(50)


@query(
    "union_parts",
    "SELECT kind, count(*) AS n, round(sum(amount), 2) AS amount FROM (SELECT 'order' AS kind, o_totalprice AS amount FROM orders UNION ALL SELECT 'line', l_extendedprice FROM lineitem) GROUP BY kind",
)
def union_parts(spark, d):
    a = table(spark, d, "orders").select(F.lit("order").alias("kind"), F.col("o_totalprice").alias("amount"))
    b = table(spark, d, "lineitem").select(F.lit("line").alias("kind"), F.col("l_extendedprice").alias("amount"))
    return a.unionByName(b).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


# ---- tiles --------------------------------------------------------------------------------------


@query(
    "tile_grid",
    """WITH s AS (SELECT p_partkey, greatest(1, round_even(p_size * 40 * f, 0))::INT AS w, greatest(1, round_even(p_size * 30 * f, 0))::INT AS h, l FROM part, (VALUES (0, 1.0), (1, 0.5)) v(l, f)),
       x AS (SELECT *, CASE WHEN w <= 256 THEN [0] ELSE list_distinct(list_concat(range(0, w - 255, 256), [w - 256])) END AS xs, CASE WHEN h <= 256 THEN [0] ELSE list_distinct(list_concat(range(0, h - 255, 256), [h - 256])) END AS ys FROM s)
       SELECT p_partkey, l::INT AS scale_level, w AS scaled_image_width, h AS scaled_image_height, sum(len(xs) * len(ys))::BIGINT AS tiles, list_max(xs)::INT AS last_x, list_max(ys)::INT AS last_y FROM x GROUP BY ALL""",
)
def tile_grid(spark, d):
    images = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 40).alias("image_width"), (F.col("p_size") * 30).alias("image_height"))
    grid = tiling.tile_grid(images, PatchOptions(magnification_factors=(1.0, 0.5)))
    return grid.groupBy("p_partkey", "scale_level", "scaled_image_width", "scaled_image_height").agg(
        F.count(F.lit(1)).alias("tiles"), F.max("patch_x").alias("last_x"), F.max("patch_y").alias("last_y")
    )


@query(
    "clipped_crops",
    "SELECT p_partkey, greatest(0, least(p_partkey % 600 + 256, p_size * 20) - p_partkey % 600)::BIGINT AS width FROM part WHERE p_partkey % 600 < p_size * 20",
)
def clipped_crops(spark, d):
    """Crops clipped to their image; crops outside it go."""
    x, w = F.col("p_partkey") % 600, F.col("p_size") * 20
    return table(spark, d, "part").where(x < w).select("p_partkey", F.greatest(F.lit(0), F.least(x + 256, w) - x).cast("long").alias("width"))


@query(
    "patch_size_defaults",
    "SELECT p_partkey, coalesce(CASE WHEN p_size % 2 = 0 THEN p_size END, 256)::INT AS patch_size, coalesce(CASE WHEN p_size % 3 = 0 THEN 99 END, CASE WHEN p_size % 3 = 1 THEN greatest(1, round_even(p_size * 0.5, 0)) END, p_size)::INT AS width FROM part",
)
def patch_size_defaults(spark, d):
    size = F.col("p_size")
    return table(spark, d, "part").select(
        "p_partkey", F.coalesce(F.when(size % 2 == 0, size), F.lit(256)).cast("int").alias("patch_size"),
        F.coalesce(F.when(size % 3 == 0, 99), F.when(size % 3 == 1, tiles.scaled_side(size, F.lit(0.5))), size).cast("int").alias("width"),
    )


def _pseudo_tiles(spark, d):
    """Tile rows with made-up but repeatable features: one grid a supplier group."""
    rows = table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 20).alias("s"), (F.col("l_partkey") % 12).alias("r"), (F.col("l_orderkey") % 10).alias("c")).agg(
        F.sum("l_quantity").cast("long").alias("q"), F.count(F.lit(1)).alias("n")
    )
    features = [(((F.col("q") * (k + 3) + F.col("n") * (2 * k + 1)) % 97) / 97.0).cast("float").alias(name) for k, name in enumerate(BASE_FEATURES)]
    return rows.select(
        F.concat(F.lit("s"), F.col("s").cast("string")).alias("sample_id"), F.lit(0).alias("scale_level"), F.col("r").cast("int").alias("grid_row"),
        F.col("c").cast("int").alias("grid_col"), (F.col("r") * 10 + F.col("c")).cast("int").alias("patch_index"), *features,
    )


TILE_SQL = "g AS (SELECT l_suppkey % 20 AS s, l_partkey % 12 AS r, l_orderkey % 10 AS c, sum(l_quantity)::BIGINT AS q, count(*) AS n FROM lineitem GROUP BY 1, 2, 3), t AS (SELECT 's' || s AS sample_id, r::INT AS grid_row, c::INT AS grid_col, (r * 10 + c)::INT AS patch_index, " + ", ".join(
    f"(((q * {k + 3} + n * {2 * k + 1}) % 97) / 97.0::DOUBLE)::FLOAT::DOUBLE AS {name}" for k, name in enumerate(BASE_FEATURES)
) + " FROM g), b AS (SELECT *, d_hist_50_75 + d_hist_75_100 AS m0, (d_hist_50_75::FLOAT + d_hist_75_100::FLOAT)::DOUBLE AS mass, CASE WHEN dab_in_nuc_frac >= dab_ring_frac AND dab_in_nuc_frac >= dab_extra_frac THEN 0 WHEN dab_ring_frac >= dab_extra_frac THEN 1 ELSE 2 END AS place FROM t), u AS (SELECT *, (4 * place + CASE WHEN mass < 0.05 THEN 0 WHEN mass < 0.20 THEN 1 WHEN mass < 0.45 THEN 2 ELSE 3 END)::INT AS state_bin FROM b)"

_GAP = " + ".join(f"abs(a.{c} - o.{c})" for c in SEMANTIC_FEATURES)
NEIGHBOR_SQL = TILE_SQL + f""", k AS (SELECT a.sample_id, a.patch_index, avg({_GAP}) AS l1_mean, max({_GAP}) AS l1_max, avg(abs(a.d_mean - o.d_mean)) AS d_diff, avg(abs(a.mass - o.mass)) AS pos_diff,
  avg(abs(a.nuclei_frac - o.nuclei_frac)) AS nuc_diff, avg(CASE WHEN a.state_bin <> o.state_bin THEN 1.0 ELSE 0.0 END) AS change
  FROM u a JOIN u o ON a.sample_id = o.sample_id AND abs(a.grid_row - o.grid_row) + abs(a.grid_col - o.grid_col) = 1 GROUP BY ALL),
  f AS (SELECT u.*, coalesce(l1_mean, 0)::FLOAT::DOUBLE AS neigh_sem_l1_mean, coalesce(l1_max, 0)::FLOAT::DOUBLE AS neigh_sem_l1_max, coalesce(d_diff, 0)::FLOAT::DOUBLE AS neigh_d_mean_diff, coalesce(pos_diff, 0)::FLOAT::DOUBLE AS neigh_posfrac_diff,
  coalesce(nuc_diff, 0)::FLOAT::DOUBLE AS neigh_nuc_frac_diff, coalesce(change, 0)::FLOAT::DOUBLE AS neigh_state_change_frac FROM u LEFT JOIN k USING (sample_id, patch_index))"""


@query(
    "grid_neighbors",
    "WITH " + NEIGHBOR_SQL + " SELECT sample_id, patch_index, round(neigh_sem_l1_mean, 4) AS l1_mean, round(neigh_sem_l1_max, 4) AS l1_max, round(neigh_d_mean_diff, 4) AS d_diff, round(neigh_posfrac_diff, 4) AS pos_diff, round(neigh_nuc_frac_diff, 4) AS nuc_diff, round(neigh_state_change_frac, 4) AS change FROM f",
)
def grid_neighbors(spark, d):
    out = neighbors.neighbor_features(_pseudo_tiles(spark, d))
    r = lambda c, n: F.round(F.col(c).cast("double"), 4).alias(n)
    return out.select(
        "sample_id", "patch_index", r("neigh_sem_l1_mean", "l1_mean"), r("neigh_sem_l1_max", "l1_max"), r("neigh_d_mean_diff", "d_diff"),
        r("neigh_posfrac_diff", "pos_diff"), r("neigh_nuc_frac_diff", "nuc_diff"), r("neigh_state_change_frac", "change"),
    )


@query(
    "state_interface_bins",
    "WITH " + NEIGHBOR_SQL + """ SELECT sample_id, patch_index, state_bin, CASE WHEN neigh_state_change_frac < 0.25 AND neigh_posfrac_diff < 0.08 THEN 0 WHEN neigh_state_change_frac < 0.50 AND neigh_posfrac_diff < 0.15 THEN 1
       WHEN neigh_state_change_frac < 0.75 AND neigh_posfrac_diff < 0.30 THEN 2 ELSE 3 END::INT AS interface_bin FROM f""",
)
def state_interface_bins(spark, d):
    return neighbors.neighbor_features(_pseudo_tiles(spark, d)).select("sample_id", "patch_index", "state_bin", "interface_bin")


SCORE_SQL = NEIGHBOR_SQL + ", md AS (SELECT sample_id, " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SEMANTIC_FEATURES) + " FROM f GROUP BY 1), ma AS (SELECT sample_id, " + ", ".join(
    f"quantile_cont(abs({c} - m_{c}), 0.5) AS a_{c}" for c in SEMANTIC_FEATURES
) + " FROM f JOIN md USING (sample_id) GROUP BY 1), sc AS (SELECT f.sample_id, f.patch_index, " + ", ".join(
    f"({c} - m_{c}) / CASE WHEN (CASE WHEN a_{c} > 1e-6 THEN 1.4826 * a_{c} ELSE s_{c} END) > 1e-6 THEN (CASE WHEN a_{c} > 1e-6 THEN 1.4826 * a_{c} ELSE s_{c} END) ELSE 1 END AS {c}" for c in SEMANTIC_FEATURES
) + " FROM f JOIN md USING (sample_id) JOIN ma USING (sample_id)), ce AS (SELECT sample_id, patch_index, -(" + " + ".join(f"abs({c} - avg({c}) OVER w)" for c in SEMANTIC_FEATURES) + f""") AS centrality FROM sc WINDOW w AS (PARTITION BY sample_id)),
  pr AS (SELECT a.sample_id, a.patch_index, {_GAP} AS gap, row_number() OVER (PARTITION BY a.sample_id, a.patch_index ORDER BY {_GAP}, o.patch_index) AS nth FROM sc a JOIN sc o ON a.sample_id = o.sample_id AND a.patch_index <> o.patch_index),
  ra AS (SELECT sample_id, patch_index, avg(gap) AS rarity FROM pr WHERE nth <= 3 GROUP BY 1, 2),
  w0 AS (SELECT f.sample_id, f.patch_index, coalesce(rarity, 0) AS rarity, centrality, d_hist_50_75 + 2.0::DOUBLE * d_hist_75_100 + 0.5::DOUBLE * d_pos_mean AS tail, log_lap_var + 0.5::DOUBLE * grad_p90 AS quality,
    neigh_sem_l1_mean + 0.5::DOUBLE * neigh_posfrac_diff + 0.5::DOUBLE * neigh_state_change_frac AS edge, unexpected_color_frac + fold_frac + 0.5::DOUBLE * hole_frac + 0.25::DOUBLE * border_tissue_frac AS nuisance, compartment_margin
    FROM f JOIN ce USING (sample_id, patch_index) LEFT JOIN ra USING (sample_id, patch_index)),
  w1 AS (SELECT *, rarity + 0.5::DOUBLE * tail + 0.25::DOUBLE * compartment_margin AS coverage FROM w0),
  z AS (SELECT sample_id, patch_index, """ + ", ".join(
    f"CASE WHEN stddev_pop({c}) OVER w < 1e-6 THEN 0 ELSE ({c} - avg({c}) OVER w) / stddev_pop({c}) OVER w END AS z_{c}" for c in ("rarity", "centrality", "tail", "quality", "edge", "nuisance", "coverage")
) + " FROM w1 WINDOW w AS (PARTITION BY sample_id))"


@query(
    "local_scores",
    "WITH " + SCORE_SQL + """ SELECT sample_id, patch_index, round(z_rarity, 4) + 0.0 AS rarity_score, round(z_quality, 4) + 0.0 AS quality_score, round(z_centrality + 0.5 * z_quality - 0.5 * z_nuisance, 4) + 0.0 AS prototype_score,
       round(z_tail + 0.25 * z_quality - 0.5 * z_nuisance, 4) + 0.0 AS positive_tail_score, round(z_coverage + 0.25 * z_edge - 0.25 * z_nuisance, 4) + 0.0 AS rare_state_score, round(z_edge + 0.25 * z_quality - 0.5 * z_nuisance, 4) + 0.0 AS interface_role_score,
       round(0.5 * z_coverage + 0.3 * z_edge + 0.15 * z_quality + 0.2 * z_rarity - 0.35 * z_nuisance, 4) + 0.0 AS objective_score FROM z""",
)
def local_scores(spark, d):
    out = scores.local_scores(neighbors.neighbor_features(_pseudo_tiles(spark, d)))
    names = ["rarity_score", "quality_score", "prototype_score", "positive_tail_score", "rare_state_score", "interface_role_score", "objective_score"]
    return out.select("sample_id", "patch_index", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in names])


@query("local_coreset")
def local_coreset(spark, d):
    """Six tiles of each sample at most: a role each, then what adds most."""
    options = PatchOptions(local_keep_max=6)
    out = coreset.select_coreset(scores.local_scores(neighbors.neighbor_features(_pseudo_tiles(spark, d)), options), options)
    return out.select("sample_id", "patch_index", "selection_rank", "selection_role", "local_valid_patch_count")


@query(
    "keep_counts",
    "SELECT o_custkey, count(*) AS n, least(count(*), least(4, greatest(1, ceil(0.1 * count(*)))))::BIGINT AS keep FROM orders GROUP BY o_custkey",
)
def keep_counts(spark, d):
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("keep", coreset.keep_count(F.col("n")))


@query("image_candidates")
def image_candidates(spark, d):
    """Synthetic stained images through decoding, tiling, description, scoring and the coreset."""
    return tiling.local_select(synthetic_images(spark, 6, 96), PatchOptions(patch_size=32, patch_stride=32, magnification_factors=(1.0, 0.5), local_keep_max=6, local_keep_ratio=0.4))


@query(
    "colours",
    """WITH c AS (SELECT p_partkey, (p_partkey * 7) % 256 AS r, (p_partkey * 13) % 256 AS g, (p_partkey * 29) % 256 AS b FROM part)
       SELECT p_partkey, round((0.299 * r + 0.587 * g + 0.114 * b)::DOUBLE / 255.0, 6) AS gray, round(CASE WHEN greatest(r, g, b) > 0 THEN (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b)::DOUBLE ELSE 0 END, 6) AS saturation,
              round(greatest(0, least(1, (r - 20) / greatest(200 - 20, 0.001)))::DOUBLE, 6) AS channel FROM c""",
)
def colours(spark, d):
    k = F.col("p_partkey")
    r, g, b = (k * 7) % 256, (k * 13) % 256, (k * 29) % 256
    return table(spark, d, "part").select(
        "p_partkey", F.round(tiles.gray(r, g, b), 6).alias("gray"), F.round(tiles.saturation(r, g, b), 6).alias("saturation"),
        F.round(tiles.normalize_channel(r, F.lit(20), F.lit(200)), 6).alias("channel"),
    )


# ---- vectors and clusters -----------------------------------------------------------------------


def _points(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("point_id"), "embedding", F.col("label").cast("long").alias("cluster_id"))


PAIR_SQL = "x AS (SELECT a.vec_id AS a, b.vec_id AS b, a.embedding::DOUBLE[] AS x, b.embedding::DOUBLE[] AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"


@query(
    "vector_distances",
    "WITH " + PAIR_SQL + """ SELECT a, b, round(list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS l2, round(2 - 2 * list_dot_product(x, y), 6) AS cos, round(list_dot_product(x, x), 6) AS norm FROM x""",
)
def vector_distances(spark, d):
    p = _points(spark, d)
    q = p.select((F.col("point_id") - 1).alias("before"), F.col("point_id").alias("b"), F.col("embedding").alias("y"))
    return p.join(q, F.col("point_id") == F.col("before")).select(
        F.col("point_id").alias("a"), "b", F.round(vectors.l2_distance(F.col("embedding"), F.col("y")), 6).alias("l2"),
        F.round(vectors.cos_distance(F.col("embedding"), F.col("y")), 6).alias("cos"), F.round(vectors.squared_norm(F.col("embedding")), 6).alias("norm"),
    )


@query(
    "power_distances",
    """SELECT event_id, round(pow(value / 100 - 0.5, 4), 6) AS distance, round(4 * pow(value / 100 - 0.5, 3), 12) + 0.0 AS slope, round(12 * pow(value / 100 - 0.5, 2), 9) AS curve FROM events""",
)
def power_distances(spark, d):
    x, c = F.col("value") / 100, F.lit(0.5)
    return table(spark, d, "events").select(
        "event_id", F.round(vectors.power_distance(x, c, 2), 6).alias("distance"), (F.round(vectors.power_slope(x, c, 2), 12) + F.lit(0.0)).alias("slope"), F.round(vectors.power_curve(x, c, 2), 9).alias("curve")
    )


MEAN_SQL = "e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS place FROM embeddings), m AS (SELECT label, place, avg(v) AS v, count(*) AS n FROM e GROUP BY 1, 2)"


@query("cluster_means", "WITH " + MEAN_SQL + " SELECT label::BIGINT AS cluster_id, place::INT AS place, round(v, 6) AS value, n FROM m")
def cluster_means(spark, d):
    return kmeans.mean_vectors(_points(spark, d)).select("cluster_id", "place", F.round("value", 6).alias("value"), "n")


def _label_centres(spark, d):
    means = kmeans.mean_vectors(_points(spark, d)).orderBy("cluster_id", "place").collect()
    ids = sorted({r["cluster_id"] for r in means})
    return np.array([[r["value"] for r in means if r["cluster_id"] == c] for c in ids]), np.array(ids)


ASSIGN_SQL = MEAN_SQL + """, d AS (SELECT e.vec_id, m.label AS cluster_id, sum((e.v - m.v) * (e.v - m.v)) AS dist FROM e JOIN m USING (place) GROUP BY 1, 2),
  a AS (SELECT vec_id, cluster_id, dist, row_number() OVER (PARTITION BY vec_id ORDER BY round(dist, 9), cluster_id) AS nth FROM d), near AS (SELECT * FROM a WHERE nth = 1)"""


@query("assign_nearest", "WITH " + ASSIGN_SQL + " SELECT vec_id AS point_id, cluster_id::BIGINT AS cluster_id, round(dist, 5) AS dist FROM near")
def assign_nearest(spark, d):
    centres, ids = _label_centres(spark, d)
    return kmeans.assign_nearest(_points(spark, d), centres, "l2", ids).select("point_id", "cluster_id", F.round("dist", 5).alias("dist"))


@query(
    "sorted_members",
    "WITH " + ASSIGN_SQL + " SELECT vec_id AS point_id, cluster_id::BIGINT AS cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY round(dist, 9), vec_id)::INT AS rank FROM near",
)
def sorted_members(spark, d):
    centres, ids = _label_centres(spark, d)
    near = kmeans.assign_nearest(_points(spark, d), centres, "l2", ids).withColumn("dist", F.round("dist", 9))
    return kmeans.sort_members(near).select("point_id", "cluster_id", "rank")


@query(
    "closest_members",
    "WITH " + ASSIGN_SQL + " SELECT point_id, cluster_id FROM (SELECT vec_id AS point_id, cluster_id::BIGINT AS cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY round(dist, 9), vec_id) AS rank FROM near) WHERE rank <= 5",
)
def closest_members(spark, d):
    centres, ids = _label_centres(spark, d)
    near = kmeans.assign_nearest(_points(spark, d), centres, "l2", ids).withColumn("dist", F.round("dist", 9))
    return kmeans.closest_members(near, 5).select("point_id", "cluster_id")


@query(
    "random_members",
    """SELECT point_id, cluster_id, rank FROM (SELECT vec_id AS point_id, label::BIGINT AS cluster_id, row_number() OVER (PARTITION BY label ORDER BY md5('3:' || vec_id), vec_id)::INT AS rank FROM embeddings)
       WHERE rank <= 5""",
)
def random_members(spark, d):
    """Five members of each cluster in a seeded order."""
    return kmeans.random_members(_points(spark, d), 5, 3).select("point_id", "cluster_id", "rank")


@query(
    "cluster_lists",
    "SELECT r.c AS cluster_id, coalesce(m, 0)::BIGINT AS size, first::VARCHAR AS first, last::VARCHAR AS last FROM range(12) r(c) LEFT JOIN (SELECT label, count(*) AS m, min(vec_id) AS first, max(vec_id) AS last FROM embeddings GROUP BY label) x ON x.label = r.c",
)
def cluster_lists(spark, d):
    """Members of clusters 0 to 11, the empty ones included."""
    lists = kmeans.cluster_lists(_points(spark, d), 12)
    return lists.select(
        "cluster_id", F.size("members").cast("long").alias("size"), F.try_element_at("members", F.lit(1)).cast("string").alias("first"),
        F.try_element_at("members", F.lit(-1)).cast("string").alias("last"),
    )


@query(
    "potential",
    "WITH " + MEAN_SQL + " SELECT round(sum((e.v - m.v) * (e.v - m.v)), 4) AS potential FROM e JOIN m USING (label, place)",
)
def potential(spark, d):
    return spark.createDataFrame([(round(kmeans.potential(_points(spark, d)), 4),)], "potential double")


LLOYD = """c0 AS (SELECT vec_id AS c, generate_subscripts(embedding, 1) AS place, unnest(embedding)::DOUBLE AS v FROM embeddings WHERE vec_id < 5),
e AS (SELECT vec_id, generate_subscripts(embedding, 1) AS place, unnest(embedding)::DOUBLE AS v FROM embeddings)"""
for _k in (1, 2, 3):
    LLOYD += f""", d{_k} AS (SELECT e.vec_id, c, sum((e.v - c{_k - 1}.v) * (e.v - c{_k - 1}.v)) AS dist FROM e JOIN c{_k - 1} USING (place) GROUP BY 1, 2),
a{_k} AS (SELECT vec_id, arg_min(c, (round(dist, 10), c)) AS c FROM d{_k} GROUP BY vec_id),
n{_k} AS (SELECT a{_k}.c, place, avg(v) AS v FROM a{_k} JOIN e USING (vec_id) GROUP BY 1, 2),
c{_k} AS (SELECT c{_k - 1}.c, c{_k - 1}.place, coalesce(n{_k}.v, c{_k - 1}.v) AS v FROM c{_k - 1} LEFT JOIN n{_k} USING (c, place))"""


@query("lloyd_two_rounds", "WITH " + LLOYD + " SELECT vec_id AS point_id, c AS cluster_id FROM a3")
def lloyd_two_rounds(spark, d):
    """Two Lloyd rounds from the first five points, then a last assignment."""
    p = _points(spark, d).select("point_id", "embedding")
    centres = np.array([r["embedding"] for r in p.where(F.col("point_id") < 5).orderBy("point_id").collect()], float)
    for _ in range(2):
        centres, _ = kmeans.centroids(kmeans.assign_nearest(p, centres), centres)
    return kmeans.assign_nearest(p, centres).select("point_id", "cluster_id")


@query("kmeans")
def kmeans_full(spark, d):
    """Ten clusters of the embeddings, seeded by greedy draws."""
    return kmeans.kmeans(_points(spark, d), 10, 10, "kmeans++", seed=1)[1].select("point_id", "cluster_id", F.round("dist", 5).alias("dist"))


@query("kmeans_parallel")
def kmeans_parallel(spark, d):
    """Ten clusters seeded by a few oversampled passes."""
    return kmeans.kmeans(_points(spark, d), 10, 10, "kmeans||", seed=1)[1].select("point_id", "cluster_id")


@query("split_clusters")
def split_clusters(spark, d):
    """Every label cut into three parts."""
    return kmeans.split_clusters(_points(spark, d), 3, 10, 2).select("parent_id", "cluster_id", "rank", "point_id")


@query("hierarchical_kmeans")
def hierarchical_kmeans(spark, d):
    """Two levels over the embeddings with resampling."""
    levels = [hierarchy.Level(20, 2), hierarchy.Level(4)]
    return hierarchy.hierarchical_kmeans(_points(spark, d), levels, 5, "kmeans||", resamples=1, seed=2)[0]


@query("power_kmeans")
def power_kmeans(spark, d):
    """One-dimensional clusters of event values under the fourth power."""
    values = table(spark, d, "events").select(F.col("event_id").alias("point_id"), "value")
    return kmeans.power_kmeans(values, 5, 2, 5)[1]


@query("ring_sample")
def ring_sample(spark, d):
    """Rings clustered in two levels and sampled evenly."""
    levels = [hierarchy.Level(30), hierarchy.Level(5)]
    edges, _ = hierarchy.hierarchical_kmeans(rings(spark, [20000, 200, 1000, 500, 8000]), levels, 5, "kmeans||", seed=3)
    from siftwell.tables import settle

    return sampling.hierarchical_sample(settle(edges), 2, 200, 1, "r", 5)


# ---- hierarchies and sampling -------------------------------------------------------------------


def _edges(spark, d):
    """Regions over nations over customers; customers ranked by balance."""
    customers = table(spark, d, "customer")
    rank = F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc(), "c_custkey"))
    one = customers.select(F.lit(1).alias("level"), F.col("c_nationkey").cast("long").alias("cluster_id"), F.col("c_custkey").alias("child_id"), rank.alias("rank"))
    nation = table(spark, d, "nation")
    order = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    two = nation.select(F.lit(2).alias("level"), F.col("n_regionkey").cast("long").alias("cluster_id"), F.col("n_nationkey").cast("long").alias("child_id"), order.alias("rank"))
    return one.unionByName(two)


@query(
    "cluster_sizes",
    """WITH f AS (SELECT n_regionkey AS r, c_nationkey AS n, c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey),
       s AS (SELECT 1 AS level, c_nationkey AS cluster_id, count(*) AS size, count(*) AS flat_size FROM customer GROUP BY c_nationkey
             UNION ALL SELECT 2, n_regionkey, count(*), (SELECT count(*) FROM f WHERE r = n_regionkey) FROM nation GROUP BY n_regionkey)
       SELECT level::INT AS level, cluster_id::BIGINT AS cluster_id, size, flat_size, row_number() OVER (PARTITION BY level ORDER BY size DESC, cluster_id)::INT AS size_order,
              row_number() OVER (PARTITION BY level ORDER BY flat_size DESC, cluster_id)::INT AS flat_size_order FROM s""",
)
def cluster_sizes(spark, d):
    return hierarchy.cluster_sizes(_edges(spark, d), 2)


@query(
    "flat_clusters",
    """SELECT 1::INT AS level, c_nationkey::BIGINT AS cluster_id, c_custkey AS point_id FROM customer UNION ALL SELECT 2, n_regionkey, c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def flat_clusters(spark, d):
    return hierarchy.flatten(_edges(spark, d), 2)


WATER = """a AS (SELECT c_nationkey AS id, count(*) AS cap FROM customer GROUP BY 1),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, count(*) OVER () - row_number() OVER (ORDER BY cap, id) + 1 AS n_left, row_number() OVER (ORDER BY cap, id) AS nth FROM a),
x AS (SELECT arg_min((600 - before) // n_left, nth) AS x FROM o WHERE (600 - before) // n_left < cap),
b AS (SELECT id, cap, x, CASE WHEN x IS NULL THEN cap ELSE least(cap, x) END AS base FROM o, x),
s AS (SELECT id, cap, base + CASE WHEN x IS NOT NULL AND cap > x AND sum(CASE WHEN cap > x THEN 1 ELSE 0 END) OVER (ORDER BY id) <= 600 - sum(base) OVER () THEN 1 ELSE 0 END AS share FROM b)"""


@query("water_fill", "WITH " + WATER + " SELECT id AS cluster_id, cap AS capacity, share::BIGINT AS share FROM s")
def water_fill(spark, d):
    """600 customers shared over the nations as evenly as their sizes allow."""
    sizes = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("cluster_id")).agg(F.count(F.lit(1)).alias("capacity"))
    rows = sizes.withColumns({"whole": F.lit(0), "target": F.lit(600).cast("long")})
    return sampling.water_fill(rows, ["whole"], "capacity", "target", "cluster_id", [F.col("cluster_id")]).select("cluster_id", "capacity", "share")


def _water(parents: str, children: str, lucky: str = "id") -> str:
    """SQL that pours targets of ``parents`` (p, target) over ``children`` (p, id, cap): (id, cap, share)."""
    return f"""SELECT id, cap, base + CASE WHEN x IS NOT NULL AND cap > x AND sum(CASE WHEN cap > x THEN 1 ELSE 0 END) OVER (PARTITION BY p ORDER BY {lucky}) <= target - sum(base) OVER (PARTITION BY p) THEN 1 ELSE 0 END AS share
      FROM (SELECT p, id, cap, target, x, CASE WHEN x IS NULL THEN cap ELSE least(cap, x) END AS base
        FROM (SELECT *, min(CASE WHEN lv < cap THEN {{'n': nth, 'lv': lv}} END) OVER (PARTITION BY p).lv AS x
          FROM (SELECT *, (target - before) // n_left AS lv FROM (SELECT c.p, c.id, c.cap, t.target, row_number() OVER w AS nth, count(*) OVER (PARTITION BY c.p) - row_number() OVER w + 1 AS n_left,
            coalesce(sum(cap) OVER (PARTITION BY c.p ORDER BY cap, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({children}) c JOIN ({parents}) t USING (p) WINDOW w AS (PARTITION BY c.p ORDER BY cap, id)))))"""


def _two_levels(target: int, times: int, lucky: str = "id") -> str:
    region = _water(f"SELECT 0 AS p, {target} AS target", f"SELECT 0 AS p, n_regionkey AS id, count(*) * {times} AS cap FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_regionkey", lucky)
    nation = _water("SELECT id AS p, share AS target FROM regions", f"SELECT n_regionkey AS p, n_nationkey AS id, count(*) * {times} AS cap FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2", lucky)
    return f"regions AS ({region}), nations AS ({nation})"


@query("two_level_targets", "WITH " + _two_levels(500, 1) + " SELECT id::BIGINT AS cluster_id, cap AS size, share::BIGINT AS share FROM nations")
def two_level_targets(spark, d):
    return sampling.cluster_targets(_edges(spark, d), 2, 500, 1, "c")


def _sample_sql(target: int, times: int, lucky: str = "id", order: str = "c_acctbal DESC, c_custkey") -> str:
    return "WITH " + _two_levels(target, times, lucky) + f""", k AS (SELECT c_custkey, c_nationkey, share, cap / {times} AS size, row_number() OVER (PARTITION BY c_nationkey ORDER BY {order}) AS nth FROM customer JOIN nations ON id = c_nationkey),
      r AS (SELECT c_custkey AS point_id, c_nationkey::BIGINT AS cluster_id, (floor(share / size) + CASE WHEN nth <= share - floor(share / size) * size THEN 1 ELSE 0 END)::BIGINT AS copies FROM k)
      SELECT * FROM r WHERE copies > 0"""


@query("hierarchical_sample_closest", _sample_sql(500, 1))
def hierarchical_sample_closest(spark, d):
    return sampling.hierarchical_sample(_edges(spark, d), 2, 500, 1, "c")


@query("hierarchical_sample_copies", _sample_sql(2000, 3))
def hierarchical_sample_copies(spark, d):
    """More points than there are: up to three copies each."""
    return sampling.hierarchical_sample(_edges(spark, d), 2, 2000, 3, "c")


@query("expand_copies", "WITH t AS (" + _sample_sql(2000, 3) + ") SELECT point_id, count(*) AS rows FROM t, range(t.copies) r(i) GROUP BY point_id")
def expand_copies(spark, d):
    sample = sampling.hierarchical_sample(_edges(spark, d), 2, 2000, 3, "c")
    return sampling.expand_copies(sample).groupBy("point_id").agg(F.count(F.lit(1)).alias("rows"))


@query("hierarchical_sample_random", _sample_sql(500, 1, "md5('9:' || id), id", "md5('10:' || c_custkey), c_custkey"))
def hierarchical_sample_random(spark, d):
    """The same budget with a seeded choice."""
    return sampling.hierarchical_sample(_edges(spark, d), 2, 500, 1, "r", 9)


from siftwell.plans import stored  # noqa: E402, F401  registers its queries
