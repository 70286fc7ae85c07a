"""Numbers of label sets from stored HyperLogLog states, for any range without the samples.

A state says which label sets a step bucket has seen, in at most ``2 ** lg_k`` bytes. States of several
buckets unite without counting a label set twice, so windows and ranges come from the states
alone. Few label sets are counted exactly; of many the relative standard error is
``1.04 / sqrt(2 ** lg_k)``, whatever number of states is united.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions.timegrid import (
    BUCKET,
    WINDOW_KEYS,
    expand_buckets,
    literal_like,
    with_bucket,
)

LG_K = 12


def error_of(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / 2 ** (lg_k / 2)


def label_states(
    samples: DataFrame, by: list[str], labels: list[str], step_s: int, ts: str = "ts", lg_k: int = LG_K
) -> DataFrame:
    """One state per key and step bucket; a label set with nulls counts like any other."""
    state = F.hll_sketch_agg(F.xxhash64(F.struct(*labels)), F.lit(lg_k)).alias("labels")
    return with_bucket(samples, ts, step_s).groupBy(*by, BUCKET).agg(state)


def united(states: DataFrame, by: list[str]) -> DataFrame:
    """One state per key and bucket, of several."""
    return states.groupBy(*by, BUCKET).agg(F.hll_union_agg("labels").alias("labels"))


def _count() -> Column:
    return F.hll_sketch_estimate(F.hll_union_agg("labels")).alias("n_series")


def windowed_cardinality(states: DataFrame, by: list[str], range_s: int, step_s: int) -> DataFrame:
    """``n_series`` per key and sliding window; buckets unite before they are repeated per window."""
    once = united(states, by)
    return expand_buckets(once, by, range_s, step_s).groupBy(*by, *WINDOW_KEYS).agg(_count())


def cardinality_between(states: DataFrame, by: list[str], start: datetime, end: datetime) -> DataFrame:
    """``n_series`` per key over the whole buckets that begin in ``[start, end)``."""
    low, high = literal_like(states, BUCKET, start), literal_like(states, BUCKET, end)
    return states.where((F.col(BUCKET) >= low) & (F.col(BUCKET) < high)).groupBy(*by).agg(_count())
