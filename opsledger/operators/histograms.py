"""Cumulative latency histograms and quantiles read from them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.functions.timegrid import WINDOW_KEYS, sliding_sums
from opsledger.model import LATENCY_BOUNDS

INF = float("inf")


def bucket_counts(value: str, bounds: tuple = LATENCY_BOUNDS) -> dict[str, Column]:
    """One conditional count per bound; a value equal to a bound is inside it."""
    counts = {f"__b{i}": F.count_if(F.col(value) <= b) for i, b in enumerate(bounds)}
    return {**counts, f"__b{len(bounds)}": F.count(value)}


def bucket_rows(wide: DataFrame, bounds: tuple = LATENCY_BOUNDS) -> DataFrame:
    """From one column per bucket to ``le, cum_count`` rows."""
    les = [*bounds, INF]
    lines = F.array(
        *[
            F.struct(F.lit(le).cast("double").alias("le"), F.col(f"__b{i}").alias("cum_count"))
            for i, le in enumerate(les)
        ]
    )
    kept = [c for c in wide.columns if not c.startswith("__b")]
    return wide.select(*kept, F.inline(lines))


def latency_histogram(
    df: DataFrame, keys: list[str], value: str, bounds: tuple = LATENCY_BOUNDS
) -> DataFrame:
    """``le, cum_count`` per label set, with its observation count and sum."""
    wide = df.groupBy(*keys).agg(
        *[agg.alias(name) for name, agg in bucket_counts(value, bounds).items()],
        F.count(value).alias("observations"),
        F.sum(value).alias("observed_sum"),
    )
    return bucket_rows(wide, bounds)


def windowed_histogram(
    df: DataFrame,
    keys: list[str],
    value: str,
    ts: str,
    range_s: int,
    step_s: int,
    bounds: tuple = LATENCY_BOUNDS,
) -> DataFrame:
    """The histogram of each sliding window."""
    wide = sliding_sums(df, keys, ts, range_s, step_s, bucket_counts(value, bounds))
    return bucket_rows(wide, bounds)


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Quantile per key from ``le, cum_count`` rows, linear inside the bucket.

    The first bucket starts at 0. A quantile in the unbounded bucket reads as the
    highest finite bound. No observations, or no unbounded bucket, give null.
    Each key has one row per bound, so these windows stay small.
    """
    if not 0 <= q <= 1:
        raise ValueError(f"quantile {q} is outside [0, 1]")
    by_bound = Window.partitionBy(*keys).orderBy("le")
    so_far = by_bound.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    ranked = (
        buckets.withColumn("__cum", F.max("cum_count").over(so_far))
        .withColumn("__low", F.lag("le").over(by_bound))
        .withColumn("__below", F.lag("__cum", 1, 0).over(by_bound))
        .withColumn("__total", F.max("__cum").over(whole))
        .withColumn("__top", F.max("le").over(whole))
    )
    rank = F.lit(float(q)) * F.col("__total")
    low = F.coalesce("__low", F.least(F.lit(0.0), F.col("le")))
    inside = F.try_divide(rank - F.col("__below"), F.col("__cum") - F.col("__below"))
    estimate = F.when(F.col("le") == INF, F.col("__low")).otherwise(
        low + (F.col("le") - low) * F.coalesce(inside, F.lit(0.0))
    )
    defined = (F.col("__total") > 0) & (F.col("__top") == INF)
    reached = F.when(defined & (F.col("__cum") >= rank), estimate)
    return ranked.groupBy(*keys).agg(
        F.min_by(reached, F.when(reached.isNotNull(), F.col("le"))).alias("quantile")
    )


def quantile_of_counts(q: float, bounds: tuple = LATENCY_BOUNDS) -> Column:
    """The same quantile from one row that holds all of ``bucket_counts``."""
    if not 0 <= q <= 1:
        raise ValueError(f"quantile {q} is outside [0, 1]")
    total = F.col(f"__b{len(bounds)}")
    rank = F.lit(float(q)) * total
    found = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        cum, below = F.col(f"__b{i}"), F.col(f"__b{i - 1}") if i else F.lit(0)
        low = bounds[i - 1] if i else min(0.0, bounds[0])
        inside = F.coalesce(F.try_divide(rank - below, cum - below), F.lit(0.0))
        found = F.when(cum >= rank, F.lit(low) + F.lit(bounds[i] - low) * inside).otherwise(found)
    return F.when(total > 0, found)


def latency_quantile(
    df: DataFrame,
    keys: list[str],
    value: str,
    q: float,
    ts: str,
    range_s: int,
    step_s: int,
    bounds: tuple = LATENCY_BOUNDS,
) -> DataFrame:
    """Quantile per key and window, through a histogram that stays in one row."""
    wide = sliding_sums(df, keys, ts, range_s, step_s, bucket_counts(value, bounds))
    return wide.select(*keys, *WINDOW_KEYS, quantile_of_counts(q, bounds).alias("quantile"))
