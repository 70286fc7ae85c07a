"""Evaluation grid: half-open windows ``[start, end)``, evaluated at ``end``.

A sliding window that covers ``range_s`` and moves by ``step_s`` holds every row
``range_s / step_s`` times. The helpers here aggregate rows to step-sized buckets
first and repeat only the buckets, which is exact for anything that merges.
"""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "bucket"
WINDOW_KEYS = ("window_start", "window_end")

FEW_COPIES = 4
RANGES_PER_SLOT = 8


_UTC = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


def check_utc(df: DataFrame) -> None:
    """Times are read and printed in UTC, so the session must use it."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC:
        raise ValueError(f"spark.sql.session.timeZone is {zone}; set it to UTC")


def moment(value: datetime) -> Column:
    """A Python time as a literal; without a zone it is UTC, wherever the driver runs."""
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def moment_or_now(value: datetime | None) -> Column:
    return F.current_timestamp() if value is None else moment(value).cast("timestamp")


def check_grid(range_s: int, step_s: int) -> None:
    if step_s <= 0 or range_s <= 0 or range_s % step_s:
        raise ValueError(f"range {range_s}s must be a positive multiple of step {step_s}s")


def seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


def floor_to(ts: Column | str, width_s: int, offset_s: int = 0) -> Column:
    """Start of the ``width_s`` slot that holds ``ts``, in the type of ``ts``."""
    width = f"{width_s} seconds"
    return F.window(ts, width, width, f"{offset_s} seconds")["start"]


def with_bucket(df: DataFrame, ts: str, step_s: int, offset_s: int = 0) -> DataFrame:
    check_utc(df)
    return df.withColumn(BUCKET, floor_to(ts, step_s, offset_s))


def expand_buckets(
    df: DataFrame,
    keys: list[str],
    range_s: int,
    step_s: int,
    offset_s: int = 0,
    clustered: bool = False,
) -> DataFrame:
    """Replace ``bucket`` by each window that contains the whole bucket.

    A bucket becomes ``range_s / step_s`` rows. When that is many, neighbouring buckets
    of a key are brought together first, so that their copies merge in the task that
    makes them and not after a shuffle of all copies. ``clustered`` says that
    they are together already, or that the copies are not going to be merged.
    """
    check_grid(range_s, step_s)
    if not clustered and range_s // step_s > FEW_COPIES:
        slot = floor_to(BUCKET, RANGES_PER_SLOT * range_s, offset_s)
        df = df.withColumn("__slot", slot).repartition(*keys, "__slot").drop("__slot")
    window = F.window(
        BUCKET, f"{range_s} seconds", f"{step_s} seconds", f"{offset_s} seconds"
    )
    return (
        df.withColumn("__w", window)
        .withColumn("window_start", F.col("__w.start"))
        .withColumn("window_end", F.col("__w.end"))
        .drop("__w", BUCKET)
    )


def sliding_sums(
    df: DataFrame,
    keys: list[str],
    ts: str,
    range_s: int,
    step_s: int,
    counts: dict[str, Column],
    offset_s: int = 0,
) -> DataFrame:
    """Sliding totals of additive aggregates, e.g. ``{"n": F.count("*")}``."""
    check_grid(range_s, step_s)
    per_bucket = (
        with_bucket(df, ts, step_s, offset_s)
        .groupBy(*keys, BUCKET)
        .agg(*[agg.alias(name) for name, agg in counts.items()])
    )
    return (
        expand_buckets(per_bucket, keys, range_s, step_s, offset_s)
        .groupBy(*keys, *WINDOW_KEYS)
        .agg(*[F.sum(name).alias(name) for name in counts])
    )


def literal_like(df: DataFrame, column: str, value: datetime | Column) -> Column:
    """``value`` in the exact type of ``column``, so that a filter reaches the scan."""
    lit = value if isinstance(value, Column) else moment(value)
    return lit.cast(df.schema[column].dataType)


def in_range(df: DataFrame, column: str, start, end, date_column: str | None = None) -> DataFrame:
    """Rows with ``start <= column < end``.

    ``date_column`` names a partition column that holds the date of ``column``, so that
    folders of other dates are not even listed.
    """
    check_utc(df)
    low, high = literal_like(df, column, start), literal_like(df, column, end)
    rows = df.where((F.col(column) >= low) & (F.col(column) < high))
    if date_column is None:
        return rows
    return rows.where(F.col(date_column).between(low.cast("date"), high.cast("date")))


def in_last(
    df: DataFrame, column: str, length_s: int, as_of: datetime | None = None
) -> DataFrame:
    """Rows of the last ``length_s`` seconds before ``as_of`` (default: now)."""
    end = moment_or_now(as_of)
    return in_range(df, column, end - seconds(length_s), end)
