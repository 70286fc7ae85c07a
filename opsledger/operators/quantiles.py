"""Exact interpolated quantiles of weighted values that never gather a large group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, so it is used only
for groups of counted, bounded size. Larger groups are never expanded: values are counted once,
sorted by range, and the running weight of each value says whether it holds the wanted rank.

Over sliding windows, the sorted values of each step bucket are summarised first: of
``points`` equal parts of its weight, the value that holds each border, with the exact
weight below it and with it. Summaries merge: the ranks of any value in a window are known to
``1 / points`` of the window's weight from the cut points of its buckets alone, whatever the
weights are. So each window gets a bracket, and only the values inside are sorted again.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.functions.cumulative import running_weights
from opsledger.functions.joins import join_same, lookup_join
from opsledger.functions.timegrid import BUCKET, WINDOW_KEYS, expand_buckets
from opsledger.functions.workspace import stored

SMALL_GROUP = 100_000
POINTS = 256


def exact_quantile(
    df: DataFrame,
    keys: list[str],
    value: str,
    q: float,
    small_group: int = SMALL_GROUP,
    weight: str | None = None,
) -> DataFrame:
    """``quantile`` of the non-null values per key, interpolated linearly.

    ``weight`` names a column that says how often a row's value counts; rows that count less
    than once do not. Groups are counted first. The result is exact whatever ``small_group`` is;
    it decides how the work is spread. ``df`` is read more than once, so it should be
    a scan with cheap expressions on top.
    """
    _check(q)
    copies = F.lit(1) if weight is None else F.col(weight)
    values = df.where(F.col(value).isNotNull() & (copies > 0)).select(
        *keys, F.col(value).alias("v"), copies.cast("long").alias("w")
    )
    counts = stored(values.groupBy(*keys).agg(F.sum("w").alias("n")), "quantile-counts")
    large = F.col("n") > small_group
    if counts.where(large).isEmpty():
        return _of_small_groups(values, keys, q)
    split = lookup_join(values, counts.select(*keys, large.alias("is_large")), keys, nulls_match=True)
    counted = split.where("is_large").groupBy(*keys, "v").agg(F.sum("w").alias("w"))
    ranked = running_weights(counted, keys, "v", "w", "quantile-values").select("*", *_ranks(q, "total"))
    return _of_small_groups(split.where("NOT is_large"), keys, q).unionByName(_picked(ranked, keys))


def _check(q: float) -> None:
    if not 0 <= q <= 1:
        raise ValueError(f"quantile {q} is outside [0, 1]")


def _of_small_groups(values: DataFrame, keys: list[str], q: float) -> DataFrame:
    return values.groupBy(*keys).agg(F.percentile("v", q, F.col("w")).alias("quantile"))


def _ranks(q: float, total: str) -> list[Column]:
    """The two ranks (from 0) that the quantile lies between, and how far; exact for any long."""
    place = F.lit(Decimal(str(q))) * (F.col(total) - 1).cast("decimal(20,0)")
    low = F.floor(place)
    return [
        low.cast("long").alias("low_rank"),
        F.ceil(place).cast("long").alias("high_rank"),
        (place - low).cast("double").alias("fraction"),
    ]


def _holds(rank: str) -> Column:
    return (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("upto"))


def _picked(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """Interpolate between the values that hold the two ranks."""
    at_low, at_high = F.col("at_low"), F.col("at_high")
    return (
        ranked.where(_holds("low_rank") | _holds("high_rank"))
        .groupBy(*keys)
        .agg(
            F.max(F.when(_holds("low_rank"), F.col("v"))).alias("at_low"),
            F.max(F.when(_holds("high_rank"), F.col("v"))).alias("at_high"),
            F.max("fraction").alias("fraction"),
        )
        .select(*keys, (at_low + (at_high - at_low) * F.col("fraction")).alias("quantile"))
    )


def quantile_summary(counted: DataFrame, keys: list[str], points: int = POINTS) -> DataFrame:
    """At most ``points + 1`` cut points per key: value, weight ``before`` and ``upto`` it, ``total``.

    ``counted`` has one row per key and value: ``v`` and its weight ``w``, a positive long.
    """
    placed = running_weights(counted, keys, "v", "w", "quantile-summary")
    part = lambda c: F.floor(F.col(c).cast("decimal(20,0)") * points / F.col("total"))
    return placed.where((part("before") < part("upto")) | (F.col("before") == 0)).select(
        *keys, "v", "before", "upto", "total"
    )


def quantile_bounds(
    summaries: DataFrame, by: list[str], q: float, range_s: int, step_s: int
) -> DataFrame:
    """A bracket of the quantile of each window, from the summaries of its step buckets alone.

    The values that the quantile is interpolated from are above ``low`` (null: unbounded) and
    at most ``high``. ``low_rank``, ``high_rank`` are their ranks, ``fraction`` the place between.
    """
    _check(q)
    keys = [*by, *WINDOW_KEYS]
    cuts = Window.partitionBy(*by, BUCKET).orderBy("v")
    # between two cut points the weight of a bucket is at least the first's, at most the next's
    most = F.lead("before").over(cuts)
    steps = (
        summaries.withColumn("most", F.coalesce(most, "total"))
        .withColumn("d_least", F.col("upto") - F.lag("upto", 1, 0).over(cuts))
        .withColumn("d_most", F.col("most") - F.coalesce(F.lag("most").over(cuts), F.lit(0)))
        .withColumn("d_total", F.when(F.col("before") == 0, F.col("total")).otherwise(0))
        .select(*by, BUCKET, "v", "d_least", "d_most", "d_total")
    )
    sums = [F.sum(c).alias(c) for c in ("d_least", "d_most", "d_total")]
    merged = expand_buckets(steps, by, range_s, step_s).groupBy(*keys, "v").agg(*sums)
    along = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    bounds = merged.select(
        *keys,
        "v",
        F.sum("d_least").over(along).alias("least"),
        F.sum("d_most").over(along).alias("most"),
        F.sum("d_total").over(Window.partitionBy(*keys)).alias("total"),
    )
    ranked = bounds.select("*", *_ranks(q, "total"))
    return ranked.groupBy(*keys).agg(
        F.max(F.when(F.col("most") <= F.col("low_rank"), F.col("v"))).alias("low"),
        F.min(F.when(F.col("least") > F.col("high_rank"), F.col("v"))).alias("high"),
        *[F.max(c).alias(c) for c in ("total", "low_rank", "high_rank", "fraction")],
    )


def windowed_quantile(
    counted: DataFrame,
    by: list[str],
    q: float,
    range_s: int,
    step_s: int,
    small_group: int = SMALL_GROUP,
    points: int = POINTS,
) -> DataFrame:
    """Exact ``quantile`` per label and sliding window.

    ``counted`` is a stored table with one row per label, step bucket and value: ``v`` and its weight
    ``w``, a positive long. Windows that weigh more than ``small_group`` go through
    summaries; ``small_group`` and ``points`` do not change the result.
    """
    _check(q)
    keys = [*by, *WINDOW_KEYS]
    per_bucket = counted.groupBy(*by, BUCKET).agg(F.sum("w").alias("n"))
    windows = expand_buckets(per_bucket, by, range_s, step_s).groupBy(*keys).agg(F.sum("n").alias("n"))
    values = expand_buckets(counted, by, range_s, step_s, clustered=True)
    sizes = stored(windows.select(*keys, (F.col("n") > small_group).alias("is_large")), "quantile-windows")
    large = sizes.where("is_large")
    if large.isEmpty():
        return _of_small_groups(values, keys, q)
    labels = large.select(*by).distinct()
    hot = lookup_join(counted, labels, by, "left_semi", nulls_match=True) if by else counted
    bounds = quantile_bounds(quantile_summary(hot, [*by, BUCKET], points), by, q, range_s, step_s)
    brackets = stored(
        join_same(bounds, large.drop("is_large"), keys, "left_semi").select(
            *keys, "low", "high", "low_rank", "high_rank", "fraction"
        ),
        "quantile-brackets",
    )
    placed = lookup_join(values, brackets, keys, nulls_match=True)
    under = F.coalesce(F.col("v") <= F.col("low"), F.lit(False))
    base = placed.groupBy(*keys).agg(
        F.sum(F.when(under, F.col("w")).otherwise(0)).alias("base"),
        *[F.max(c).alias(c) for c in ("low_rank", "high_rank", "fraction")],
    )
    inside = placed.where(~under & (F.col("v") <= F.col("high"))).groupBy(*keys, "v").agg(F.sum("w").alias("w"))
    sorted_ = running_weights(inside, keys, "v", "w", "quantile-inside")
    ranked = join_same(sorted_, base, keys).select(
        *keys,
        "v",
        *[(F.col(c) + F.col("base")).alias(c) for c in ("before", "upto")],
        "low_rank",
        "high_rank",
        "fraction",
    )
    others = lookup_join(values, sizes.where("NOT is_large").drop("is_large"), keys, nulls_match=True)
    return _of_small_groups(others, keys, q).unionByName(_picked(ranked, keys))
