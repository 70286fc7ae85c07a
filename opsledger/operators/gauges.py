"""Gauges: the latest sample counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.functions.timegrid import (
    BUCKET,
    WINDOW_KEYS,
    check_grid,
    expand_buckets,
    with_bucket,
)

# CPU utilisation target in percent.
CPU_TARGET_PCT = 70.0


def latest_sample(
    samples: DataFrame,
    series: list[str],
    range_s: int,
    step_s: int,
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Latest value of each series in each lookback window, and its time.

    An older sample does not count. ``max_by`` needs no sort and merges over step
    buckets; a series has one sample per time.
    """
    check_grid(range_s, step_s)
    per_bucket = (
        with_bucket(samples, ts, step_s)
        .groupBy(*series, BUCKET)
        .agg(F.max_by(value, ts).alias("value"), F.max(ts).alias("sample_ts"))
    )
    return (
        expand_buckets(per_bucket, series, range_s, step_s)
        .groupBy(*series, *WINDOW_KEYS)
        .agg(F.max_by("value", "sample_ts").alias("value"), F.max("sample_ts").alias("sample_ts"))
    )


def latest_ratio(
    latest: DataFrame, series: list[str], numerator: str, denominator: str, metric: str = "metric"
) -> DataFrame:
    """Ratio of two metrics in a table of latest samples, with equal labels.

    Both come from the same rows, so one grouping does the one-to-one match;
    windows in which either metric has no sample drop out.
    """

    def of(name: str):
        return F.max(F.when(F.col(metric) == name, F.col("value")))

    return (
        latest.where(F.col(metric).isin(numerator, denominator))
        .groupBy(*series, *WINDOW_KEYS)
        .agg(of(numerator).alias("numerator"), of(denominator).alias("denominator"))
        .where("numerator IS NOT NULL AND denominator IS NOT NULL")
        .withColumn("ratio", F.try_divide("numerator", "denominator"))
    )


def gauge_ratio(
    samples: DataFrame,
    series: list[str],
    numerator: str,
    denominator: str,
    range_s: int,
    step_s: int,
    metric: str = "metric",
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Ratio of the latest values of two metrics with equal labels."""
    chosen = samples.where(F.col(metric).isin(numerator, denominator))
    latest = latest_sample(chosen, [*series, metric], range_s, step_s, ts, value)
    return latest_ratio(latest, series, numerator, denominator, metric)


def utilisation(
    usage: DataFrame,
    keys: list[str],
    range_s: int,
    step_s: int,
    ts: str = "ts",
    used: str = "value",
    requested: str = "requested",
    target_pct: float = CPU_TARGET_PCT,
    pod: str = "pod",
) -> DataFrame:
    """Mean over pods of usage over request in percent, and whether it is above the target.

    Each pod counts once per window, however often it reports.
    """
    check_grid(range_s, step_s)
    pct = F.try_divide(used, requested) * 100
    per_bucket = (
        with_bucket(usage, ts, step_s)
        .groupBy(*keys, pod, BUCKET)
        .agg(F.sum(pct).alias("total"), F.count(pct).alias("n"))
    )
    mean = F.try_divide(F.sum("total"), F.sum("n"))
    return (
        expand_buckets(per_bucket, [*keys, pod], range_s, step_s)
        .groupBy(*keys, pod, *WINDOW_KEYS)
        .agg(mean.alias("__of_pod"))
        .groupBy(*keys, *WINDOW_KEYS)
        .agg(F.avg("__of_pod").alias("utilisation_pct"))
        .withColumn("above_target", F.col("utilisation_pct") > target_pct)
    )
