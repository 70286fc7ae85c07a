"""Labelled counters: counts, reset-aware deltas, increase and rate.

A series can be long and there can be few of them, so nothing here sorts a
whole series in one task. Samples are split by (series, time chunk), and the
last sample of each chunk is carried into the series' next chunk.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.functions.timegrid import (
    BUCKET,
    WINDOW_KEYS,
    check_grid,
    expand_buckets,
    floor_to,
    sliding_sums,
    with_bucket,
)

# Default range, evaluation step and restart range, in seconds.
RANGE_S = 300
STEP_S = 30
RESTART_RANGE_S = 900

CHUNK_S = 3600
_CHUNK = "__chunk"


def label_counts(df: DataFrame, labels: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*labels).agg(F.count("*").alias(name))


def series_cardinality(
    samples: DataFrame, metric: str, labels: list[str], approximate: bool = False
) -> DataFrame:
    """Number of label sets per metric, exact unless asked otherwise.

    Spark removes duplicates by (metric, label set) before it counts per
    metric, so one dominant metric is spread over all tasks.
    """
    label_set = F.struct(*labels)
    count = F.approx_count_distinct(F.xxhash64(label_set)) if approximate else F.count_distinct(label_set)
    return samples.groupBy(metric).agg(count.alias("n_series"))


def counter_deltas(
    samples: DataFrame,
    series: list[str],
    ts: str = "ts",
    value: str = "value",
    chunk_s: int = CHUNK_S,
) -> DataFrame:
    """Add ``prev_ts``, ``prev_value`` and ``delta`` to each sample.

    ``delta`` is the growth since the previous sample of the series, or the
    value itself when the counter went down, which means it was restarted. The
    first sample of a series has no delta. A series has one sample per time.
    """
    return _chunked_deltas(samples, series, ts, value, chunk_s).drop(_CHUNK)


def _chunked_deltas(
    samples: DataFrame, series: list[str], ts: str, value: str, chunk_s: int
) -> DataFrame:
    """The deltas, partitioned by series and the chunk that each row still names."""
    columns = [*series, ts, value]
    chunked = samples.select(*columns, floor_to(ts, chunk_s).alias(_CHUNK))
    ends = chunked.groupBy(*series, _CHUNK).agg(
        F.max(ts).alias(ts), F.max_by(value, ts).alias(value)
    )
    in_series = Window.partitionBy(*series).orderBy(_CHUNK)
    carried = (
        ends.withColumn(_CHUNK, F.lead(_CHUNK).over(in_series))
        .where(f"{_CHUNK} IS NOT NULL")
        .select(*columns, _CHUNK, F.lit(True).alias("__carried"))
    )
    rows = chunked.withColumn("__carried", F.lit(False)).unionByName(carried)
    in_chunk = Window.partitionBy(*series, _CHUNK).orderBy(ts)
    growth = F.col(value) - F.col("prev_value")
    return (
        rows.withColumn("prev_ts", F.lag(ts).over(in_chunk))
        .withColumn("prev_value", F.lag(value).over(in_chunk))
        .where(~F.col("__carried"))
        .withColumn("delta", F.when(growth < 0, F.col(value)).otherwise(growth))
        .drop("__carried")
    )


def counter_increase(
    samples: DataFrame,
    series: list[str],
    range_s: int = RANGE_S,
    step_s: int = STEP_S,
    ts: str = "ts",
    value: str = "value",
    chunk_s: int = CHUNK_S,
) -> DataFrame:
    """Growth of each series in each window that holds two samples or more.

    A delta counts only when both of its samples lie inside the window, and
    nothing is extrapolated to the window's edges. A step bucket keeps the growth
    between its own samples apart from the delta of its first one; a window adds the
    former of all its buckets, and the latter of all but its first bucket. Nothing is
    subtracted, so small growth after a restart is not lost beside large values. The
    buckets are made per chunk, where the deltas already are, without a shuffle.
    """
    check_grid(range_s, step_s)
    deltas = _chunked_deltas(samples, series, ts, value, chunk_s)
    inside = F.coalesce(F.col("prev_ts") >= F.col(BUCKET), F.lit(False))
    per_bucket = (
        with_bucket(deltas, ts, step_s)
        .groupBy(*series, _CHUNK, BUCKET)
        .agg(
            F.sum(F.when(inside, F.col("delta"))).alias("inner"),
            F.min(ts).alias("first_ts"),
            F.min_by(F.when(~inside, F.col("delta")), ts).alias("first_delta"),
            F.count("*").alias("n_samples"),
        )
    )
    zero = F.lit(0.0)

    def added(parts: Column) -> Column:
        return F.aggregate(parts, zero, lambda total, part: total + F.coalesce(part, zero))

    # One entry per bucket of the window, so the list is as short as range / step; a
    # bucket that two chunks share has one entry for each.
    parts = F.sort_array(F.collect_list(F.struct("first_ts", "first_delta", "inner")))
    return (
        expand_buckets(per_bucket, series, range_s, step_s, clustered=True)
        .groupBy(*series, *WINDOW_KEYS)
        .agg(parts.alias("parts"), F.sum("n_samples").alias("n_samples"))
        .where("n_samples >= 2")
        .withColumn("later", F.slice("parts", F.lit(2), F.size("parts")))
        .select(
            *series,
            *WINDOW_KEYS,
            (
                added(F.transform("later", lambda p: p["first_delta"]))
                + added(F.transform("parts", lambda p: p["inner"]))
            ).alias("increase"),
        )
    )


def counter_rate(
    samples: DataFrame, series: list[str], range_s: int = RANGE_S, step_s: int = STEP_S, **options
) -> DataFrame:
    """Growth per second over the window."""
    grown = counter_increase(samples, series, range_s, step_s, **options)
    return grown.withColumn("rate", F.col("increase") / range_s).drop("increase")


def event_rate(
    df: DataFrame,
    keys: list[str],
    ts: str = "ts",
    range_s: int = RANGE_S,
    step_s: int = STEP_S,
    where: Column | None = None,
) -> DataFrame:
    """Rows per second and key over sliding windows."""
    rows = df if where is None else df.where(where)
    counts = sliding_sums(rows, keys, ts, range_s, step_s, {"n": F.count("*")})
    return counts.withColumn("rate", F.col("n") / range_s)
