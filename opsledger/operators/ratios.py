"""Ratios and matches between series.

An undefined ratio is null, never NaN: Spark orders NaN above every number, so
a NaN would pass a ``>`` threshold.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions.text import matches_whole
from opsledger.functions.timegrid import WINDOW_KEYS, sliding_sums

# Which status codes are server errors.
SERVER_ERROR = "5.."


def windowed_ratio(
    df: DataFrame,
    keys: list[str],
    part: Column,
    ts: str,
    range_s: int,
    step_s: int,
) -> DataFrame:
    """Share of rows for which ``part`` holds, per key and window, in one pass."""
    sums = sliding_sums(
        df, keys, ts, range_s, step_s, {"n_part": F.count_if(part), "n_all": F.count("*")}
    )
    return sums.withColumn("ratio", F.try_divide("n_part", "n_all"))


def error_ratio(
    requests: DataFrame, keys: list[str], ts: str, range_s: int, step_s: int
) -> DataFrame:
    """Server errors over all requests, summed over the status codes first."""
    return windowed_ratio(
        requests, keys, matches_whole("status_code", SERVER_ERROR), ts, range_s, step_s
    )


def series_ratio(
    numerator: DataFrame, denominator: DataFrame, on: list[str], value: str = "value"
) -> DataFrame:
    """One-to-one ratio of two series with equal labels; unmatched labels drop out."""
    top = numerator.select(*on, F.col(value).alias("numerator"))
    bottom = denominator.select(*on, F.col(value).alias("denominator"))
    return top.join(bottom, on, "inner").withColumn(
        "ratio", F.try_divide("numerator", "denominator")
    )


def series_and(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` whose labels also occur in ``right``."""
    return left.join(right, on, "left_semi")


def publishing_counts(
    events: DataFrame, keys: list[str], ts: str, range_s: int, step_s: int
) -> DataFrame:
    """Orders created and events published per window; ``stalled`` when none of
    the created orders led to an event. ``kind`` tells the two apart, so one pass
    replaces a left join of two series."""
    created = F.count_if(F.col("kind") == "created")
    published = F.count_if(F.col("kind") == "published")
    sums = sliding_sums(
        events, keys, ts, range_s, step_s, {"created": created, "published": published}
    )
    return sums.withColumn("stalled", (F.col("created") > 0) & (F.col("published") == 0))


def publishing_stalled(
    events: DataFrame, keys: list[str], ts: str, range_s: int, step_s: int
) -> DataFrame:
    return (
        publishing_counts(events, keys, ts, range_s, step_s)
        .where("stalled")
        .select(*keys, *WINDOW_KEYS, "created")
    )
