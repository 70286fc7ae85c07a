"""Routing, delivery, duplicate removal and reconciliation of events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.functions.joins import lookup_join
from opsledger.functions.text import topic_regex
from opsledger.model import DEFAULT_CHANNEL, DEFAULT_TEMPLATE


def subscribe(events: DataFrame, pattern: str = "#", key: str = "event_type") -> DataFrame:
    """Events whose routing key matches a topic pattern."""
    return events.where(F.col(key).rlike(topic_regex(pattern)))


def with_channels(
    events: DataFrame, rules: DataFrame, default: Column, is_small: bool | None = None
) -> DataFrame:
    """Add ``channels``: the rule's list, or the default when there is no rule."""
    joined = lookup_join(events, rules, ["event_type"], "left", is_small=is_small)
    return joined.withColumn("channels", F.coalesce("channels", default))


def route_events(
    events: DataFrame, rules: DataFrame, default: Column, is_small: bool | None = None
) -> DataFrame:
    """One row per (event, channel), ``pos`` keeping the order of the channels.

    The list is exploded after the join: an empty list gives no rows, a missing
    rule gives the default list.
    """
    return (
        with_channels(events, rules, default, is_small)
        .select("*", F.posexplode("channels").alias("pos", "__c"))
        .withColumn("channel", F.coalesce("__c.type", F.lit(DEFAULT_CHANNEL)))
        .withColumn("template", F.coalesce("__c.template", F.lit(DEFAULT_TEMPLATE)))
        .withColumn("retry", F.col("__c.retry"))
        .withColumn("level", F.col("__c.level"))
        .drop("channels", "__c")
    )


def rule_usage(events: DataFrame, rules: DataFrame, default: Column) -> DataFrame:
    """Each rule entry, the default included, with the events that reach it.

    Events are counted per type before the join, so a common type costs no more
    than a rare one. The default is listed even if no event reaches it, and apart
    from a rule that is called ``default``.
    """
    counts = events.groupBy("event_type").agg(F.count("*").alias("n_events"))
    hits = counts.join(rules, "event_type", "full")
    named = hits.where("channels IS NOT NULL").select(
        F.col("event_type").alias("rule"),
        "channels",
        F.coalesce("n_events", F.lit(0)).alias("n_events"),
    )
    others = hits.where("channels IS NULL").agg(
        F.coalesce(F.sum("n_events"), F.lit(0)).alias("n_events")
    )
    rest = others.select(F.lit("default").alias("rule"), default.alias("channels"), "n_events")
    return named.unionByName(rest).select(
        "rule", F.posexplode("channels").alias("pos", "c"), "n_events"
    ).select(
        "rule",
        "pos",
        F.coalesce("c.type", F.lit(DEFAULT_CHANNEL)).alias("channel"),
        F.coalesce("c.template", F.lit(DEFAULT_TEMPLATE)).alias("template"),
        F.col("c.retry").alias("retry"),
        F.col("c.level").alias("level"),
        "n_events",
    )


def attempts_allowed(retry: Column | str) -> Column:
    """One attempt, and as many more as the channel's ``retry`` says."""
    return F.coalesce(F.col(retry) if isinstance(retry, str) else retry, F.lit(0)) + 1


def delivery_attempts(deliveries: DataFrame, needed: str = "attempts_needed") -> DataFrame:
    """Add attempts made, ``delivered``, and ``dead_letter`` when attempts ran out."""
    allowed = attempts_allowed("retry")
    return (
        deliveries.withColumn("attempts_made", F.least(F.col(needed), allowed))
        .withColumn("delivered", F.col(needed) <= allowed)
        .withColumn("dead_letter", ~F.col("delivered"))
    )


def is_processed(needed: str = "attempts_needed") -> Column:
    """Does each of an event's ``channels`` deliver within its attempts?"""
    return F.forall("channels", lambda c: F.col(needed) <= attempts_allowed(c["retry"]))


def message_counts(events: DataFrame, needed: str = "attempts_needed") -> DataFrame:
    """Received, processed and failed events per type.

    An event with ``channels`` is processed when each of them delivers in time.
    """
    processed = is_processed(needed)
    return events.groupBy("event_type").agg(
        F.count("*").alias("received"),
        F.count_if(processed).alias("processed"),
        F.count_if(~processed).alias("failed"),
    )


def first_deliveries(events: DataFrame, key: str = "event_id", ts: str = "ts") -> DataFrame:
    """One row per key: the earliest of its copies, whatever order they come in.

    Copies of one time are told apart by their content, column by column; maps by their entries.
    """
    rest = [f for f in events.schema if f.name != key]
    names = [f.name for f in rest]
    order = F.struct(*[ts] * (ts in names), *[_comparable(f) for f in rest if f.name != ts])
    first = events.groupBy(key).agg(F.min_by(F.struct(*names), order).alias("__first"))
    return first.select(key, *[F.col("__first")[c].alias(c) for c in names])


def _comparable(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.MapType) and isinstance(field.dataType.valueType, T.AtomicType):
        return F.array_sort(F.map_entries(field.name)).alias(field.name)
    if isinstance(field.dataType, T.AtomicType):
        return F.col(field.name)
    return F.to_json(F.struct(field.name)).alias(field.name)


def reconcile(orders: DataFrame, event_orders: DataFrame) -> DataFrame:
    """Order ids that are stored without an event, or have events but no order.

    ``event_orders`` has one ``order_id`` per event. Both sides shrink to one
    row per id before they meet, so one full outer join answers both questions.
    """
    stored = orders.groupBy("id").agg(F.count("*").alias("n_orders"))
    published = event_orders.groupBy(F.col("order_id").alias("id")).agg(
        F.count("*").alias("n_events")
    )
    both = stored.join(published, "id", "full")
    reason = F.when(F.col("n_events").isNull(), "order without event").otherwise(
        "event without order"
    )
    return both.where("n_orders IS NULL OR n_events IS NULL").select(
        F.col("id").alias("order_id"),
        reason.alias("reason"),
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.coalesce("n_events", F.lit(0)).alias("n_events"),
    )
