"""Budgeted balanced selection: bin counts, tempered quotas, and the best rows of every bin.

Null, NaN and the empty text are one bin value. A bin's share of the budget goes with its count to the power
``alpha``. Within a bin rows are ordered by finite score descending, then by the tie columns; rows without a
finite score come last and still fill a quota that nothing else fills.

The rows of a bin are never sorted together. Scores fall into slices by approximate quantiles, counts per
(bin, slice) tell which slices are taken whole and which one holds the cut, and only that slice is ranked.
"""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.config import SelectionOptions
from siftwell.functions.ranges import range_of

#: Bins whose quotas may be computed on the driver and broadcast.
DRIVER_BINS = 100_000
SLICES = 256


def normalize_bins(df: DataFrame, columns: tuple[str, ...]) -> list[Column]:
    """The bin columns with null, NaN and empty text made one value."""
    kinds = dict(df.dtypes)
    missing = [c for c in columns if c not in kinds]
    if missing:
        raise KeyError(f"missing bin columns: {missing}")
    out = []
    for c in columns:
        if kinds[c] == "string":
            out.append(F.coalesce(F.col(c), F.lit("")))
        elif kinds[c] in ("float", "double"):
            out.append(F.when(~F.isnan(c), F.col(c)))
        else:
            out.append(F.col(c))
    return out


def bin_counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(bin columns, n); without columns one global bin."""
    keys = [k.alias(c) for c, k in zip(columns, normalize_bins(df, columns), strict=True)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if keys else df.agg(F.count(F.lit(1)).alias("n"))


def allocate_quotas(counts: dict, target: int, alpha: float, min_quota: int = 0, strict_target: bool = False) -> dict:
    """Whole quotas per bin, proportional to count ** alpha and never above the count.

    Ties go to the lesser bin key. A minimum quota can exceed the target unless ``strict_target`` trims the
    largest quotas again.
    """
    keys = sorted(counts, key=lambda k: tuple(map(_sortable, k)) if isinstance(k, tuple) else (_sortable(k),))
    if not keys or target <= 0:
        return dict.fromkeys(keys, 0)
    cap = {k: counts[k] for k in keys}
    weight = {k: float(cap[k]) ** alpha for k in keys}
    total = sum(weight.values())
    if total <= 0:
        weight, total = dict.fromkeys(keys, 1.0), float(len(keys))
    share = {k: target * weight[k] / total for k in keys}
    quota = {k: min(floor(share[k]), cap[k]) for k in keys}
    if min_quota > 0 and target >= min_quota * len(keys):
        quota = {k: min(max(quota[k], min_quota), cap[k]) for k in keys}
    left = target - sum(quota.values())
    for k in sorted(keys, key=lambda k: -(share[k] - floor(share[k]))):
        if left > 0 and quota[k] < cap[k]:
            quota[k] += 1
            left -= 1
    while left > 0 and (open_ := [k for k in keys if quota[k] < cap[k]]):
        extra = dict.fromkeys(open_, 0)
        if left >= len(open_):
            total = sum(weight[k] for k in open_)
            extra = {k: min(floor(left * weight[k] / total) if total > 0 else 0, cap[k] - quota[k]) for k in open_}
        if not any(extra.values()):
            for k in sorted(open_, key=lambda k: (-weight[k], -cap[k], -quota[k]))[:left]:
                extra[k] = 1
        for k, more in extra.items():
            quota[k] += more
            left -= more
    if strict_target:
        for _ in range(sum(quota.values()) - target):
            quota[max(keys, key=lambda k: quota[k])] -= 1
    return quota


def _sortable(v) -> tuple:
    return (v is not None, str(type(v)) if v is not None else "", v if v is not None else 0)


def quota_table(counts: DataFrame, columns: tuple[str, ...], options: SelectionOptions) -> DataFrame:
    """``counts`` with ``quota``. Up to ``DRIVER_BINS`` bins the rounds run on the driver, beyond it as joins."""
    if counts.count() <= DRIVER_BINS:
        rows = counts.select(*columns, "n").collect()
        quota = allocate_quotas(
            {tuple(r[c] for c in columns): r["n"] for r in rows},
            options.target_size, options.bin_alpha, options.per_bin_min_quota, options.strict_target,
        )
        schema = counts.select(*columns).schema.add("quota", "long")
        return F.broadcast(counts.sparkSession.createDataFrame([(*k, q) for k, q in quota.items()], schema))
    return distributed_quotas(counts, columns, options).drop("n")


def distributed_quotas(counts: DataFrame, columns: tuple[str, ...], options: SelectionOptions) -> DataFrame:
    """The same rounds, and the same quotas, for more bins than the driver should hold.

    Every round is an aggregate and a projection; only a few totals reach the driver.
    """
    from siftwell.tables import settle

    target, floor_ = options.target_size, options.per_bin_min_quota
    weighed = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(options.bin_alpha))))
    totals = weighed.agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("bins")).first()
    if not totals["w"]:
        weighed, totals = weighed.withColumn("weight", F.lit(1.0)), {"w": float(totals["bins"]), "bins": totals["bins"]}
    share = F.lit(float(max(target, 0))) * F.col("weight") / F.lit(totals["w"])
    quota = F.least(F.floor(share), F.col("n"))
    if floor_ > 0 and target >= floor_ * totals["bins"]:
        quota = F.least(F.greatest(quota, F.lit(floor_)), F.col("n"))
    now = settle(weighed.withColumn("quota", quota).withColumn("part", share - F.floor(share)))
    order = [F.col("part").desc(), *columns]
    first = True
    while True:
        state = now.agg(
            F.sum("quota").alias("used"),
            F.count_if(F.col("quota") < F.col("n")).alias("open"),
            F.sum(F.when(F.col("quota") < F.col("n"), F.col("weight"))).alias("w"),
        ).first()
        left = target - state["used"]
        if left <= 0 or not state["open"]:
            now = now.drop("weight", "part")
            return _trimmed(now, columns, -left) if options.strict_target and left < 0 else now
        open_ = F.col("quota") < F.col("n")
        gain = F.least(F.floor(left * F.col("weight") / F.lit(state["w"] or 1.0)), F.col("n") - F.col("quota"))
        if not first and left >= state["open"] and now.where(open_ & (gain > 0)).limit(1).count():
            now = settle(now.withColumn("quota", F.when(open_, F.col("quota") + gain).otherwise(F.col("quota"))))
        else:
            lucky = now.where(open_).orderBy(*order).limit(min(left, state["open"])).select(*[F.col(c).alias(f"key_{c}") for c in columns], F.lit(1).alias("more"))
            same = F.lit(True)
            for c in columns:
                same = same & F.col(c).eqNullSafe(F.col(f"key_{c}"))
            now = now.join(lucky, same, "left").withColumn("quota", F.col("quota") + F.coalesce("more", F.lit(0)))
            now = settle(now.drop("more", *[f"key_{c}" for c in columns]))
        first = False
        order = [F.col("weight").desc(), F.col("n").desc(), F.col("quota").desc(), *columns]


def _trimmed(now: DataFrame, columns: tuple[str, ...], excess: int) -> DataFrame:
    """``now`` with ``excess`` taken off the largest quotas, one by one from the largest, the first key on ties.

    That leaves every quota at most at one level, and the first of those at the level one below it.
    """
    over = lambda level: now.agg(F.coalesce(F.sum(F.greatest(F.col("quota") - F.lit(level), F.lit(0))), F.lit(0))).first()[0]
    low, high = 0, now.agg(F.max("quota")).first()[0]
    while low < high:  # the lowest level that takes no more than the excess
        mid = (low + high) // 2
        low, high = (low, mid) if over(mid) <= excess else (mid + 1, high)
    rest = excess - over(low)
    cut = now.withColumn("quota", F.least("quota", F.lit(low)))
    if not rest:
        return cut
    first = cut.where(F.col("quota") == low).orderBy(*columns).limit(rest).select(*[F.col(c).alias(f"key_{c}") for c in columns], F.lit(1).alias("less"))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"key_{c}"))
    cut = cut.join(first, same, "left").withColumn("quota", F.col("quota") - F.coalesce("less", F.lit(0)))
    return cut.drop("less", *[f"key_{c}" for c in columns])


def score_order(score: str, ties: list[str]) -> list[Column]:
    """Finite scores first and descending, then the tie columns."""
    c = F.col(score).cast("double")
    return [F.when(~F.isnan(c), c).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in ties]]


def best_of_bins(df: DataFrame, columns: tuple[str, ...], score: str, ties: list[str], quotas) -> DataFrame:
    """The first ``quota`` rows of every bin; ``quotas`` makes the table of quotas from the counts."""
    keys = normalize_bins(df, columns)
    number = F.when(~F.isnan(F.col(score).cast("double")), F.col(score).cast("double"))
    points = df.agg(F.percentile_approx(number, [k / SLICES for k in range(1, SLICES)], 10_000).alias("q")).first()["q"] or []
    bounds = sorted(set(points))
    # slice 0 holds the best scores; rows without a finite score have a slice of their own
    place = F.when(number.isNull(), F.lit(len(bounds) + 1)).otherwise(F.lit(len(bounds)) - range_of(number, bounds))
    rows = df.withColumns({f"bin_{k}": key for k, key in enumerate(keys)} | {"bin_slice": place})
    names = [f"bin_{k}" for k in range(len(keys))]
    slices = rows.groupBy(*names, "bin_slice").agg(F.count(F.lit(1)).alias("n"))
    counts = slices.groupBy(*names).agg(F.sum("n").alias("n")) if names else slices.agg(F.sum("n").alias("n"))
    quota = quotas(counts.toDF(*columns, "n")).toDF(*[f"key_{k}" for k in range(len(keys))], "quota")
    same = F.lit(True)
    for k, name in enumerate(names):
        same = same & F.col(name).eqNullSafe(F.col(f"key_{k}"))
    run = Window.partitionBy(*names).orderBy("bin_slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = slices.withColumn("ahead", F.coalesce(F.sum("n").over(run), F.lit(0))).join(quota, same)
    cut = cut.where((F.col("ahead") < F.col("quota"))).groupBy(*[f"key_{k}" for k in range(len(keys))]).agg(
        F.max(F.struct("bin_slice", "ahead", "quota")).alias("c")
    )
    cut = cut.select(*[f"key_{k}" for k in range(len(keys))], F.col("c.bin_slice").alias("last"), (F.col("c.quota") - F.col("c.ahead")).alias("room"))
    placed = rows.join(cut, same)
    sure = placed.where(F.col("bin_slice") < F.col("last"))
    edge = placed.where(F.col("bin_slice") == F.col("last"))
    order = Window.partitionBy(*names).orderBy(*score_order(score, ties))
    edge = edge.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= F.col("room"))
    return sure.select(*df.columns).unionByName(edge.select(*df.columns))


def balanced_select(df: DataFrame, options: SelectionOptions) -> DataFrame:
    """The rows of ``df`` that fit the budget, balanced over the bins."""
    if options.utility_column not in df.columns:
        raise KeyError(f"missing utility column: {options.utility_column}")
    ties = [c for c in options.tie_columns if c in df.columns]
    return best_of_bins(
        df, options.bin_columns, options.utility_column, ties, lambda counts: quota_table(counts, options.bin_columns, options)
    )


def top_per_bin(df: DataFrame, columns: tuple[str, ...], score: str, k: int, ties: list[str]) -> DataFrame:
    """The best ``k`` rows of every bin with their rank; the literal bound lets Spark limit each group early."""
    order = Window.partitionBy(*columns).orderBy(*score_order(score, ties))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
