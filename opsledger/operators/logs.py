"""Log filters, enrichment, rates and correlation with alerts."""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.functions.joins import MAX_BROADCAST_ROWS, lookup_join
from opsledger.functions.text import matches_whole
from opsledger.functions.timegrid import (
    BUCKET,
    WINDOW_KEYS,
    check_grid,
    check_utc,
    expand_buckets,
    floor_to,
    literal_like,
    sliding_sums,
)
from opsledger.functions.workspace import stored
from opsledger.operators.quantiles import windowed_quantile
from opsledger.sources.logs import parse_log_json

# Most lines one log query returns.
MAX_LINES = 1000

SLOT_S = 3600
TAIL_GROUPS = 512


def label_is(**labels: str) -> Column:
    """Label equality matchers, all of which must hold."""
    condition = F.lit(True)
    for name, value in labels.items():
        condition = condition & (F.col(name) == value)
    return condition


def label_matches(**patterns: str) -> Column:
    """Label regex matchers; each pattern covers the whole value."""
    condition = F.lit(True)
    for name, pattern in patterns.items():
        condition = condition & matches_whole(name, pattern)
    return condition


def line_contains(text: str, line: str = "line") -> Column:
    return F.contains(F.col(line), F.lit(text))


def line_matches(pattern: str, line: str = "line") -> Column:
    """Line regex; it may match anywhere in the line."""
    return F.col(line).rlike(pattern)


def json_equals(field: str, value: str, ignore_case: bool = False) -> Column:
    """Field of a parsed line equals ``value``; case counts unless asked otherwise."""
    column = F.col(f"fields.{field}")
    return F.lower(column) == value.lower() if ignore_case else column == value


def json_at_least(field: str, value: float) -> Column:
    """Numeric field of a parsed line; a field that is no number does not match."""
    return _number(field) >= value


def _number(field: str) -> Column:
    return F.col(f"fields.{field}").try_cast("double")


def enrich(logs: DataFrame, targets: DataFrame) -> DataFrame:
    """Pod labels for each line; lines of unknown or stopped pods drop out."""
    labels = targets.select("uid", "container", "namespace", "pod", "app")
    return lookup_join(logs, labels, ["uid", "container"])


def line_rate(
    logs: DataFrame,
    by: list[str],
    range_s: int,
    step_s: int,
    where: Column | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Lines per second and label over sliding windows."""
    rows = logs if where is None else logs.where(where)
    counts = sliding_sums(rows, by, ts, range_s, step_s, {"n_lines": F.count("*")})
    return counts.withColumn("rate", F.col("n_lines") / range_s)


def field_quantile(
    logs: DataFrame,
    by: list[str],
    field: str,
    q: float,
    range_s: int,
    step_s: int,
    ts: str = "ts",
    approximate: bool = False,
) -> DataFrame:
    """Exact quantile of a numeric JSON field per label and sliding window.

    Quantiles do not merge over step buckets, but counts of equal values do: values are
    counted per label and bucket, and only these counts are repeated per window. The
    lines are parsed once; the counts are stored, and all later passes read those.
    ``approximate`` trades exactness for a single pass that stores nothing.
    """
    check_grid(range_s, step_s)
    numbers = (
        parse_log_json(logs, fields=(field,))
        .select(*by, floor_to(ts, step_s).alias(BUCKET), _number(field).alias("value"))
        .where("value IS NOT NULL")
    )
    keys = [*by, *WINDOW_KEYS]
    if approximate:
        near = F.percentile_approx("value", q).alias("quantile")
        return expand_buckets(numbers, by, range_s, step_s, clustered=True).groupBy(*keys).agg(near)
    counted = numbers.groupBy(*by, BUCKET, F.col("value").alias("v")).agg(F.count("*").alias("w"))
    return windowed_quantile(stored(counted, "field-values"), by, q, range_s, step_s)


def tail(
    logs: DataFrame, order: list[Column], limit: int = MAX_LINES, newest_by: str | None = None
) -> DataFrame:
    """The first ``limit`` lines in ``order``, e.g. the newest.

    Every task keeps its own first lines, then ``TAIL_GROUPS`` reducers merge those of
    many tasks, so that the last sort sees ``limit`` lines per reducer, however many
    tasks read the log. Above Spark's group limit threshold (1000) that would shuffle all
    lines; if ``order`` begins with the newest of a time column, name it as ``newest_by``. Lines
    are then counted per hour, minute and second from the newest on, and only those from the
    second that fills the limit are read and sorted.
    """
    if newest_by is not None:
        since = _since(logs, limit, newest_by)
        rows = logs if since is None else logs.where(F.col(newest_by) >= literal_like(logs, newest_by, since))
        return rows.orderBy(*order).limit(limit)
    grouped = logs.withColumn("__group", F.pmod(F.spark_partition_id(), F.lit(TAIL_GROUPS)))
    place = F.row_number().over(Window.partitionBy("__group").orderBy(*order))
    return (
        grouped.withColumn("__place", place)
        .where(F.col("__place") <= limit)
        .drop("__place", "__group")
        .orderBy(*order)
        .limit(limit)
    )


def _since(logs: DataFrame, limit: int, ts: str) -> datetime | None:
    """Start of the second from which on there are ``limit`` lines; None if there are fewer."""
    check_utc(logs)
    start, left = None, limit
    for width in (3600, 60, 1):
        rows = logs.where(F.col(ts).isNotNull())
        if start is not None:
            end = start + timedelta(seconds=wider)
            rows = rows.where((F.col(ts) >= literal_like(logs, ts, start)) & (F.col(ts) < literal_like(logs, ts, end)))
        # one row per hour of the log, then 60 rows twice
        slots = rows.groupBy(floor_to(F.col(ts).cast("timestamp_ntz"), width).alias("slot")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.orderBy(F.col("slot").desc()).rowsBetween(Window.unboundedPreceding, 0))
        found = slots.withColumn("upto", upto).where(F.col("upto") >= left).orderBy(F.col("slot").desc()).first()
        if found is None:
            return None
        start, left, wider = found["slot"], left - (found["upto"] - found["n"]), width
    return start


def interval_blocks(intervals: DataFrame, slot_s: int = SLOT_S) -> DataFrame:
    """Each interval once per aligned block (``__size``, ``__block``) of 2 ** size slots that covers it.

    The blocks of an interval do not overlap, and there are at most two of a size.
    """
    first = F.floor(F.unix_seconds(F.col("start_ts").cast("timestamp")) / slot_s)
    beyond = F.floor(F.unix_seconds(F.col("end_ts").cast("timestamp")) / slot_s) + 1
    sizes = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(beyond - first)), F.lit(0)) + 1)
    return (
        intervals.where("start_ts <= end_ts")
        .withColumn("__a", first.cast("long"))
        .withColumn("__b", beyond.cast("long"))
        .withColumn("__size", F.explode(sizes.cast("array<int>")))
        .withColumn("__a", F.expr("shiftright(__a + shiftleft(1L, __size) - 1, __size)"))
        .withColumn("__b", F.expr("shiftright(__b, __size)"))
        .where("__a < __b")
        .withColumn("__block", F.explode(F.expr("filter(array(if(__a % 2 != 0, __a, null), if(__b % 2 != 0, __b - 1, null)), x -> x is not null)")))
        .drop("__a", "__b")
    )


def logs_during(
    logs: DataFrame,
    intervals: DataFrame,
    on: list[str],
    ts: str = "ts",
    slot_s: int = SLOT_S,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Lines with the labels of an alert, written while it was active.

    Each interval is listed under aligned blocks of 1, 2, 4 .. time slots that cover what it
    touches, two of a size at most, so that an alert of a year is some thirty rows. The join
    has an equality on (labels, block) and the range check sees only lines of the
    same block. Both edges of the interval belong to it. The intervals are stored,
    because they are measured before they are joined; only lines between the first start and
    the last end are read.
    """
    kept = stored(intervals, "intervals")
    bounds = kept.agg(F.min("start_ts").alias("a"), F.max("end_ts").alias("b")).first()
    if bounds["a"] is not None:
        kind = logs.schema[ts].dataType
        first, last = (F.lit(bounds[k]).cast(kind) for k in "ab")
        logs = logs.where((F.col(ts) >= first) & (F.col(ts) <= last))
    listed = stored(interval_blocks(kept, slot_s), "interval-blocks")
    used = [r["__size"] for r in listed.select("__size").distinct().collect()]  # a few dozen sizes at most
    slot = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / slot_s).cast("long")
    places = F.array(*[F.struct(F.lit(s).alias("__size"), F.shiftright(slot, s).alias("__block")) for s in used or [0]])
    joined = lookup_join(logs.select("*", F.inline(places)), listed, [*on, "__size", "__block"], max_rows=max_rows)
    return joined.where(
        (F.col(ts) >= F.col("start_ts")) & (F.col(ts) <= F.col("end_ts"))
    ).drop("__size", "__block")
