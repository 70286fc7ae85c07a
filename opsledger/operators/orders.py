"""Order report, lookup and ingest."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions import text
from opsledger.functions.joins import lookup_join
from opsledger.functions.timegrid import (
    BUCKET,
    check_utc,
    expand_buckets,
    in_range,
    moment_or_now,
    seconds,
    with_bucket,
)
from opsledger.model import CREATED_DATE, ORDERS, PENDING, STATUSES

DAY_S = 86_400

# Default length of a report period.
REPORT_PERIOD_DAYS = 7


def lookback(period_days: int, as_of: datetime | None = None) -> tuple[Column, Column]:
    """Start and end of the period that ends at ``as_of`` (default: now)."""
    end = moment_or_now(as_of)
    return end - F.make_dt_interval(days=F.lit(period_days)), end


def orders_in_period(orders: DataFrame, start, end) -> DataFrame:
    """Orders created in the period; a table partitioned by date is pruned to it."""
    partition = CREATED_DATE if CREATED_DATE in orders.columns else None
    return in_range(orders, "created_at", start, end, partition)


def status_counts() -> list[Column]:
    per_status = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    return [F.count("*").alias("total_orders"), *per_status]


def order_summary(
    orders: DataFrame,
    period_days: int = REPORT_PERIOD_DAYS,
    as_of: datetime | None = None,
) -> DataFrame:
    """Total and per-status counts of one period: one pass, always one row.

    The total includes orders whose status is none of the three.
    """
    start, end = lookback(period_days, as_of)
    kind = orders.schema["created_at"].dataType
    return (
        orders_in_period(orders, start, end)
        .agg(*status_counts())
        .withColumn("period_start", start.cast(kind))
        .withColumn("period_end", end.cast(kind))
    )


def sliding_summary(
    orders: DataFrame,
    period_s: int = REPORT_PERIOD_DAYS * DAY_S,
    every_s: int = DAY_S,
    anchor_s: int = 6 * 3600,
) -> DataFrame:
    """The summary of every scheduled run from the first to the last that holds an order.

    Runs over empty periods in between are listed with zeros.

    A run happens every ``every_s`` seconds, ``anchor_s`` after the epoch-aligned
    start (default: daily at 06:00 UTC; weekly on Monday at 06:00 is seven days
    with an anchor of four days and six hours). Orders are counted once per
    schedule step; only those few counts are repeated per period.
    """
    per_step = (
        with_bucket(orders, "created_at", every_s, anchor_s).groupBy(BUCKET).agg(*status_counts())
    )
    return summary_of_steps(per_step, period_s, every_s, anchor_s)


def summary_of_steps(per_step: DataFrame, period_s: int, every_s: int, anchor_s: int) -> DataFrame:
    """``sliding_summary`` from the counts of each schedule step."""
    names = ["total_orders", *STATUSES]
    counted = expand_buckets(per_step, [], period_s, every_s, anchor_s)
    every, period = seconds(every_s), seconds(period_s)
    runs = counted.agg(F.min("window_end").alias("a"), F.max("window_end").alias("b")).select(
        F.explode(F.sequence("a", "b", every)).alias("window_end")
    )
    empty = runs.select(
        (F.col("window_end") - period).alias("window_start"),
        "window_end",
        *[F.lit(0).cast("long").alias(name) for name in names],
    )
    return (
        counted.unionByName(empty)
        .groupBy("window_start", "window_end")
        .agg(*[F.sum(name).alias(name) for name in names])
        .select(
            *names,
            F.col("window_start").alias("period_start"),
            F.col("window_end").alias("period_end"),
        )
    )


def _share(count: str) -> Column:
    return F.col(count) / F.greatest("total_orders", F.lit(1)) * 100


def status_shares(summary: DataFrame, with_other: bool = False) -> DataFrame:
    """Count and percent per status and a total row, in report order.

    The total row reads 100 even without orders. ``with_other`` adds a row for
    orders whose status is none of the three.
    """
    rows = [(i + 1, s, F.col(s), _share(s)) for i, s in enumerate(STATUSES)]
    source = summary
    if with_other:
        other = F.col("total_orders") - sum((F.col(s) for s in STATUSES), F.lit(0))
        source = summary.withColumn("other", other)
        rows.append((4, "other", F.col("other"), _share("other")))
    rows.append((len(rows) + 1, "total", F.col("total_orders"), F.lit(100.0)))
    lines = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(name).alias("status"),
                count.alias("n_orders"),
                pct.alias("pct"),
            )
            for i, name, count, pct in rows
        ]
    )
    return source.select("period_start", "period_end", F.inline(lines))


def report_document(summary: DataFrame) -> DataFrame:
    """The fields of the JSON report, plus the dates that name it."""
    check_utc(summary)
    return summary.select(
        text.iso_timestamp("period_start").alias("period_start"),
        text.iso_timestamp("period_end").alias("period_end"),
        "total_orders",
        F.struct(*STATUSES).alias("by_status"),
        F.to_date("period_start").alias("period_start_date"),
        F.to_date("period_end").alias("period_end_date"),
    )


def report_long(summary: DataFrame) -> DataFrame:
    """The six ``metric, value`` rows of the CSV report, in order."""
    check_utc(summary)
    metrics = [
        ("period_start", text.iso_timestamp("period_start")),
        ("period_end", text.iso_timestamp("period_end")),
        ("total_orders", F.col("total_orders").cast("string")),
        *[(s, F.col(s).cast("string")) for s in STATUSES],
    ]
    lines = F.array(
        *[
            F.struct(F.lit(i).alias("ordinal"), F.lit(m).alias("metric"), v.alias("value"))
            for i, (m, v) in enumerate(metrics, start=1)
        ]
    )
    return summary.select(
        F.to_date("period_start").alias("period_start_date"),
        F.to_date("period_end").alias("period_end_date"),
        F.inline(lines),
    )


def report_html(summary: DataFrame) -> DataFrame:
    """One HTML document per report row, built in place without grouping."""

    def row(status: str) -> Column:
        pct = _share(status)
        return F.format_string(
            '<tr data-status="%s"><th scope="row">%s</th><td>%d</td><td>%s%%</td>'
            '<td><hr align="left" style="width: %d%%"></td></tr>',
            F.lit(status),
            text.html_escape(F.lit(status)),
            F.col(status),
            text.one_decimal(pct),
            text.bar_width(pct),
        )

    start, end = F.to_date("period_start"), F.to_date("period_end")
    # The wording of the report.
    html = F.format_string(
        "<!DOCTYPE html><html><head><title>Order Report %s – %s</title></head><body>"
        "<h1>Order Summary Report</h1><p>Period: %s – %s | Generated: %s</p><table>"
        "<tr><th>Status</th><th>Count</th><th>Share</th><th></th></tr>%s"
        '<tr><th scope="row">Total</th><td>%d</td><td>100%%</td><td></td></tr>'
        "</table></body></html>",
        *[d.cast("string") for d in (start, end, start, end)],
        text.minute_label("period_end"),
        F.concat(*[row(s) for s in STATUSES]),
        F.col("total_orders"),
    )
    return summary.select(
        start.alias("period_start_date"), end.alias("period_end_date"), html.alias("html")
    )


def lookup_orders(keys: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per distinct requested ``id``, with ``found``, status and customer.

    Fails when a requested id is stored more than once, whichever columns are read.
    Only orders with a wanted id are aggregated; repeated keys and repeated stored ids
    collapse before they are shuffled.
    """
    wanted = keys.select("id").distinct()
    # the salt hashes all columns, so those not needed leave first
    needed = orders.select("id", "status", "customer_id")
    stored = lookup_join(needed, wanted, ["id"], "left_semi").groupBy("id").agg(
        F.count("*").alias("copies"),
        F.min("status").alias("status"),
        F.min("customer_id").alias("customer_id"),
    )
    matched = wanted.join(stored, "id", "left")
    duplicate = F.raise_error(F.concat(F.lit("more than one order has id "), F.col("id")))

    def single(value: Column, kind: str) -> Column:
        return F.when(F.col("copies") > 1, duplicate.cast(kind)).otherwise(value)

    return matched.select(
        "id",
        single(F.col("copies").isNotNull(), "boolean").alias("found"),
        single(F.col("status"), "string").alias("status"),
        single(F.col("customer_id"), "string").alias("customer_id"),
    )


def validate_requests(requests: DataFrame) -> DataFrame:
    """Type the request fields; add ``accepted`` and the ``reason`` for a refusal.

    Zero and negative quantities are accepted. ``given_quantity`` is what was asked for.
    """
    quantity = F.col("quantity").try_cast("int")
    reason = (
        F.when(F.col("customer_id").isNull(), "customer_id missing")
        .when(F.col("product_id").isNull(), "product_id missing")
        .when(F.col("quantity").isNull(), "quantity missing")
        .when(quantity.isNull(), "quantity not an integer")
    )
    return (
        requests.withColumn("given_quantity", F.col("quantity").cast("string"))
        .withColumn("reason", reason)
        .withColumn("accepted", F.col("reason").isNull())
        .withColumn("quantity", quantity)
    )


def rejected_requests(requests: DataFrame) -> DataFrame:
    """Requests that are refused, as they were given, and why."""
    refused = validate_requests(requests).where("NOT accepted")
    quantity = F.col("given_quantity").alias("quantity")
    return refused.select(
        *[quantity if c == "quantity" else F.col(c) for c in requests.columns], "reason"
    )


def new_orders(requests: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Accepted requests as order rows, with defaults for status, time and id.

    Ids are random, so a job must store these rows and publish events from the
    stored table, never from a second evaluation of this frame.
    """
    now = moment_or_now(as_of)
    present = set(requests.columns)

    def given(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in present else default

    accepted = validate_requests(requests).where("accepted")
    return accepted.select(
        given("id", F.uuid()).alias("id"),
        "customer_id",
        "product_id",
        "quantity",
        given("status", F.lit(PENDING)).alias("status"),
        given("created_at", now).alias("created_at"),
    ).select(*ORDERS.names)


def created_events(orders: DataFrame) -> DataFrame:
    """The ``order.created`` event of each stored order."""
    return orders.select(
        F.lit("order.created").alias("event_type"),
        F.create_map(
            F.lit("order_id"), "id", F.lit("customer_id"), "customer_id"
        ).alias("payload"),
    )
