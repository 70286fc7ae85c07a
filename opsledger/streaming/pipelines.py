"""Structured Streaming jobs: routing, duplicate removal, rates and alerts.

All of them stop when the available input is used up, and go on from their
checkpoint when started again. Pass another ``trigger`` to keep them running, and
call ``stop()`` on the returned query to end them between two micro-batches.
"""

import time
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opsledger.functions.joins import fits_broadcast, lookup_join
from opsledger.functions.text import matches_whole
from opsledger.functions.timegrid import (
    BUCKET,
    WINDOW_KEYS,
    check_grid,
    expand_buckets,
    literal_like,
    with_bucket,
)
from opsledger.functions.workspace import dropping_intermediates, stored
from opsledger.operators.alerts import alert_states
from opsledger.operators.cardinality import LG_K, label_states, united
from opsledger.operators.events import (
    attempts_allowed,
    delivery_attempts,
    first_deliveries,
    route_events,
)
from opsledger.operators.ratios import SERVER_ERROR
from opsledger.sinks.tables import run_of, write_batch
from opsledger.sources.messages import dead_letters, decode_messages, good_messages
from opsledger.streaming.keystore import BUCKETS, KeyStore
from opsledger.streaming.parts import FAN_IN, Parts
from opsledger.streaming.processors import alert_processor, delivery_processor, rocksdb_state

# Our choice: how far apart the copies of an event may be.
LATE_S = 600

# Our choice: seconds before the second, third .. attempt, and how many tasks share the waiting ones.
BACKOFF_S = (1.0, 5.0, 25.0, 120.0)
SHARDS = 64

AVAILABLE_NOW = {"availableNow": True}


def route_messages(
    messages: DataFrame,
    rules: DataFrame,
    default: Column,
    notifications: str,
    dead: str,
    checkpoint: str,
    trigger: dict | None = None,
    attempts: Column | None = None,
    undelivered: str | None = None,
) -> StreamingQuery:
    """Decode and route each message; store notifications and undecodable bodies.

    ``attempts`` says how many attempts a notification needs; those that need more than their
    channel allows go to ``undelivered``. A failed micro-batch is replayed as a whole
    and replaces its own output, so a message neither gets lost nor is stored twice.
    """
    if (attempts is None) != (undelivered is None):
        raise ValueError("attempts and undelivered belong together")
    is_small = fits_broadcast(rules)
    run = run_of(checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_messages(batch).persist()
        try:
            routed = route_events(good_messages(decoded), rules, default, is_small)
            if attempts is not None:
                routed = delivery_attempts(routed.withColumn("attempts_needed", attempts))
                late = routed.where("dead_letter").drop("delivered", "dead_letter")
                write_batch(late, undelivered, batch_id, run)
                routed = routed.where("delivered").drop("delivered", "dead_letter")
            write_batch(routed, notifications, batch_id, run)
            write_batch(dead_letters(decoded), dead, batch_id, run)
        finally:
            decoded.unpersist()

    return (
        messages.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def delivery_stream(
    deliveries: DataFrame,
    send: Callable,
    delivered: str,
    dead: str,
    checkpoint: str,
    backoff_s: tuple[float, ...] = BACKOFF_S,
    shards: int = SHARDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Send each delivery, again after a delay if it fails, until its attempts run out.

    ``deliveries`` has ``retry``, how many more attempts than one its channel allows (null: none).
    ``send`` gets pandas frames of some thousand rows with ``body``, the delivery as JSON, and
    ``attempt``; it returns whether each got through. Waiting deliveries and their attempts are the stream's state, so
    they survive a restart; what was sent just before a failure may be sent again. Settled ones are
    stored with ``attempts_made``; those out of attempts in ``dead``.

    Repeated attempts need a stream that keeps running: the default trigger is one second.
    ``settle`` waits until nothing is left to send.
    """
    spark, run = deliveries.sparkSession, run_of(checkpoint)
    # times as written by Spark, to the microsecond
    formats = {f"timestamp{kind}Format": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for kind in ("", "NTZ")}
    body = F.to_json(F.struct("*"), formats | {"ignoreNullFields": "false"})
    rows = deliveries.select(body.alias("body"), attempts_allowed("retry").cast("int").alias("allowed"))
    # a stream that goes on without new input would not look at its timers; a row of its own starts it
    spark.range(1).coalesce(1).write.mode("append").parquet(f"{checkpoint}-wake")
    wake = spark.readStream.schema("id long").parquet(f"{checkpoint}-wake").where("id < 0")
    rows = rows.unionByName(wake.select(F.lit("").alias("body"), F.lit(0).alias("allowed")))
    tried = (
        rows.withColumn("shard", F.pmod(F.xxhash64("body"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .transformWithStateInPandas(
            delivery_processor(send, [int(1000 * s) for s in backoff_s]),
            "shard int, body string, attempts_made int, delivered boolean",
            "append",
            "ProcessingTime",
        )
    )
    schema = deliveries.schema

    def store(batch: DataFrame, batch_id: int) -> None:
        once = stored(
            batch.select(F.from_json("body", schema, formats).alias("d"), "attempts_made", "delivered"), "deliveries"
        )
        for path, side in ((delivered, once.where("delivered")), (dead, once.where("NOT delivered"))):
            write_batch(side.select("d.*", "attempts_made"), path, batch_id, run)

    with rocksdb_state(spark):
        return (
            tried.writeStream.outputMode("append")
            .foreachBatch(dropping_intermediates(store))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .start()
        )


def settle(query: StreamingQuery, seconds: float = 600) -> None:
    """Wait until a ``delivery_stream`` has neither input nor waiting deliveries, and stop it."""
    end = time.monotonic() + seconds
    try:
        while time.monotonic() < end:
            if not query.isActive:
                if query.exception() is not None:
                    raise query.exception()
                return
            last = query.lastProgress
            idle = last is not None and last["numInputRows"] == 0 and last["stateOperators"]
            if idle and last["stateOperators"][0]["numRowsTotal"] == 0:
                return
            time.sleep(0.2)
        raise TimeoutError(f"deliveries are still waiting after {seconds} s")
    finally:
        query.stop()


def dedup_stream(events: DataFrame, key: str = "event_id", ts: str = "ts", late_s: int = LATE_S) -> DataFrame:
    """First delivery of each key; a copy must come within ``late_s`` of the first."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, f"{late_s} seconds").dropDuplicatesWithinWatermark([key])


def dedup_all_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "event_id",
    ts: str = "ts",
    same_time: bool = False,
    trigger: dict | None = None,
    buckets: int = BUCKETS,
    fan_in: int = FAN_IN,
) -> StreamingQuery:
    """First delivery of each key, however far apart its copies come; nothing is too late.

    Of the copies in one micro-batch the earliest counts. Keys are kept in a ``KeyStore`` under
    ``path``, events in ``path``/events. ``same_time`` says that copies carry the event's own
    time, so that only keys of its date are looked up. Rows without a key are nobody's copies.
    """
    spark, run = events.sparkSession, run_of(checkpoint)
    scope = F.coalesce(F.to_date(ts).cast("string"), F.lit("none")) if same_time else F.lit("all")

    def store(batch: DataFrame, batch_id: int) -> None:
        keys = KeyStore(spark, f"{path}/keys", checkpoint, buckets, fan_in)
        first = stored(first_deliveries(batch.where(F.col(key).isNotNull()), key, ts), "dedup-first")
        named = first.select("*", F.col(key).cast("string").alias("__key"), scope.alias("__scope"))
        asked = named.select(F.col("__key").alias("key"), F.col("__scope").alias("scope"))
        known = keys.known(asked, batch_id)
        fresh = named.join(
            known.select(F.col("key").alias("__key"), F.col("scope").alias("__scope")), ["__key", "__scope"], "left_anti"
        )
        fresh = stored(fresh, "dedup-fresh")
        out = fresh.drop("__key", "__scope").unionByName(batch.where(F.col(key).isNull()))
        write_batch(out, f"{path}/events", batch_id, run)
        new = fresh.select(F.col("__key").alias("key"), F.lit(batch_id).cast("long").alias("batch"), F.col("__scope").alias("scope"))
        keys.add(new, batch_id)

    return (
        events.writeStream.foreachBatch(dropping_intermediates(store))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def rows_behind_watermark(query: StreamingQuery) -> int:
    """Rows that came later than a stream's watermark allows, in its known progress."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def bucket_stream(
    df: DataFrame,
    keys: list[str],
    counts: dict[str, Column],
    step_s: int,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Additive aggregates per key and step bucket; each micro-batch stores its own part.

    Nothing is held back or dropped: a row counts in its bucket however late it
    comes, and a replayed micro-batch changes nothing. Parts are merged in tiers;
    ``stored_buckets`` reads them, ``windows_of`` adds them.
    """
    spark = df.sparkSession
    names = list(counts)

    def store(batch: DataFrame, batch_id: int) -> None:
        parts = with_bucket(batch, ts, step_s).groupBy(*keys, BUCKET)
        _bucket_parts(spark, path, checkpoint, keys, names).add(
            parts.agg(*[agg.alias(name) for name, agg in counts.items()]), batch_id
        )

    return (
        df.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def _bucket_parts(spark: SparkSession, path: str, checkpoint: str, keys: list[str], names: list[str]) -> Parts:
    def add_up(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, BUCKET).agg(*[F.sum(name).alias(name) for name in names])

    return Parts(spark, path, checkpoint, add_up)


def stored_buckets(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """The buckets of a ``bucket_stream`` or ``label_state_stream``; one may lie in several parts."""
    return Parts(spark, path, checkpoint).read()


def windows_of(
    buckets: DataFrame,
    keys: list[str],
    names: list[str],
    range_s: int,
    step_s: int,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Sliding totals of the stored buckets, up to all that has come so far.

    With ``start`` or ``end`` only windows that end after the one and not after the other,
    and only their buckets are read.
    """
    sums = [F.sum(name).alias(name) for name in names]
    if start is not None:
        buckets = buckets.where(F.col(BUCKET) > literal_like(buckets, BUCKET, start - timedelta(seconds=range_s)))
    if end is not None:
        buckets = buckets.where(F.col(BUCKET) < literal_like(buckets, BUCKET, end))
    merged = buckets.groupBy(*keys, BUCKET).agg(*sums)
    found = expand_buckets(merged, keys, range_s, step_s).groupBy(*keys, *WINDOW_KEYS).agg(*sums)
    if start is not None:
        found = found.where(F.col("window_end") > literal_like(found, "window_end", start))
    if end is not None:
        found = found.where(F.col("window_end") <= literal_like(found, "window_end", end))
    return found


def window_stream(
    df: DataFrame,
    keys: list[str],
    counts: dict[str, Column],
    range_s: int,
    step_s: int,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    late_s: int = LATE_S,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Sliding totals, each written once, when the watermark has passed its window.

    Two aggregations follow each other: rows to step buckets, then buckets to the windows that
    hold them, so a row is kept once however many windows it is in. Rows more than
    ``late_s`` behind the newest are not in the totals; ``window_corrections`` adds them.
    """
    check_grid(range_s, step_s)
    run = run_of(checkpoint)
    timed = df.withColumn("__at", F.col(ts).cast("timestamp")).withWatermark("__at", f"{late_s} seconds")
    step = F.window("__at", f"{step_s} seconds")
    buckets = timed.groupBy(*keys, step.alias("__step")).agg(*[agg.alias(n) for n, agg in counts.items()])
    span = F.window(F.window_time("__step"), f"{range_s} seconds", f"{step_s} seconds")
    totals = buckets.groupBy(*keys, span.alias("__window")).agg(*[F.sum(n).alias(n) for n in counts])
    kind = df.schema[ts].dataType
    found = totals.select(
        *keys,
        *[F.col(f"__window.{side}").cast(kind).alias(f"window_{side}") for side in ("start", "end")],
        *counts,
    )
    return (
        found.writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id, run))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def window_corrections(windows: DataFrame, totals: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """What must be added to each of ``windows`` to make it the true one.

    ``totals`` comes from ``windows_of``, which counts rows however late; windows that are not
    closed yet are corrections from nothing. Adding corrections to windows again and again,
    each time against the sum so far, ends at the totals.
    """
    every = [*keys, *WINDOW_KEYS]
    both = windows.select(*every, *[(-F.col(n)).alias(n) for n in names]).unionByName(totals.select(*every, *names))
    delta = both.groupBy(*every).agg(*[F.sum(n).alias(n) for n in names])
    return delta.where(reduce(or_, [F.col(n) != 0 for n in names]))


def corrected_windows(windows: DataFrame, corrections: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Windows with their corrections added."""
    every = [*keys, *WINDOW_KEYS]
    both = windows.select(*every, *names).unionByName(corrections.select(*every, *names))
    return both.groupBy(*every).agg(*[F.sum(n).alias(n) for n in names])


def event_rate_stream(
    events: DataFrame,
    keys: list[str],
    step_s: int,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Count rows per key and bucket, for ``event_rates``."""
    return bucket_stream(events, keys, {"n": F.count("*")}, step_s, path, checkpoint, ts, trigger)


def event_rates(buckets: DataFrame, keys: list[str], range_s: int, step_s: int) -> DataFrame:
    """Rows per second, key and window."""
    counts = windows_of(buckets, keys, ["n"], range_s, step_s)
    return counts.withColumn("rate", F.col("n") / range_s)


def error_ratio_stream(
    requests: DataFrame,
    keys: list[str],
    step_s: int,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Count server errors and requests per key and bucket, for ``error_ratios``."""
    errors = F.count_if(matches_whole("status_code", SERVER_ERROR))
    counts = {"n_part": errors, "n_all": F.count("*")}
    return bucket_stream(requests, keys, counts, step_s, path, checkpoint, ts, trigger)


def error_ratios(buckets: DataFrame, keys: list[str], range_s: int, step_s: int) -> DataFrame:
    """Server errors over all requests per key and window."""
    counts = windows_of(buckets, keys, ["n_part", "n_all"], range_s, step_s)
    return counts.withColumn("ratio", F.try_divide("n_part", "n_all"))


def label_state_stream(
    samples: DataFrame,
    by: list[str],
    labels: list[str],
    step_s: int,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    trigger: dict | None = None,
    lg_k: int = LG_K,
) -> StreamingQuery:
    """States of label sets per key and bucket, for ``windowed_cardinality``; late rows unite too."""
    spark = samples.sparkSession

    def store(batch: DataFrame, batch_id: int) -> None:
        parts = Parts(spark, path, checkpoint, lambda rows: united(rows, by))
        parts.add(label_states(batch, by, labels, step_s, ts, lg_k), batch_id)

    return (
        samples.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def append_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start(path)
    )


def running_counts(
    events: DataFrame, labels: list[str], path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Labelled counter over a stream: each micro-batch stores the changed totals."""
    counts = events.groupBy(*labels).agg(F.count("*").alias("n"))
    run = run_of(checkpoint)
    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id, run))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def alert_state_stream(
    evaluations: DataFrame,
    series: list[str],
    step_s: int,
    hold_s: int,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    late_s: int = LATE_S,
) -> StreamingQuery:
    """Alert states of a stream of evaluations, which may come in any order.

    ``evaluations`` has the series columns, ``eval_ts``, ``value`` (a double) and ``breach``. Each series
    keeps its evaluations of the last ``late_s`` seconds as keyed state, and of all older ones a
    single row, so a micro-batch costs the same however long the stream has run. An evaluation
    that comes late corrects what follows it; ``latest_states`` reads the last word on each.
    Those more than ``late_s`` behind the newest go to ``late_evaluations``, without a state;
    ``correct_late`` finds their states from the stored ones.
    """
    spark, run = evaluations.sparkSession, run_of(checkpoint)
    kinds = {f.name: f.dataType.simpleString() for f in evaluations.schema}
    names = ", ".join(f"`{c}` {kinds[c]}" for c in series)
    # the watermark moves timers; as a plain number the time lets late rows through to be stored
    timed = evaluations.withColumn("__at", F.col("eval_ts").cast("timestamp")).withWatermark(
        "__at", f"{late_s} seconds"
    )
    states = (
        timed.select(*series, F.unix_micros("__at").alias("at_us"), F.col("value").cast("double").alias("value"), "breach")
        .groupBy(*series)
        .transformWithStateInPandas(
            alert_processor(series, step_s, hold_s, late_s),
            f"{names}, at_us long, value double, breach boolean, since_us long, state string, late boolean",
            "append",
            "EventTime",
        )
    )
    moment = lambda c: F.timestamp_micros(c).cast(kinds["eval_ts"])
    found = states.select(
        *series, moment("at_us").alias("eval_ts"), "value", "breach",
        moment("since_us").alias("active_since"), "state", "late",
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        once = batch.persist()
        try:
            states = once.where("NOT late").drop("late").withColumn("batch_id", F.lit(batch_id))
            _state_parts(spark, path, checkpoint, series).add(states, batch_id)
            late = once.where("late").select(*series, "eval_ts", "value", "breach")
            write_batch(late, f"{path}/late", batch_id, run)
        finally:
            once.unpersist()

    with rocksdb_state(spark):
        return (
            found.writeStream.outputMode("append")
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or AVAILABLE_NOW))
            .start()
        )


def late_evaluations(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Evaluations that came too late for the state of ``alert_state_stream``."""
    return spark.read.parquet(f"{path}/late/run={run_of(checkpoint)}").drop("batch_id")


def correct_late(
    spark: SparkSession, path: str, series: list[str], checkpoint: str, step_s: int, hold_s: int
) -> DataFrame:
    """All states, with the late evaluations in their places; a batch job for when there are any.

    Only series that have late evaluations are computed again, by the batch operator.
    """
    known = latest_states(spark, path, series, checkpoint)
    late = late_evaluations(spark, path, checkpoint)
    columns = [*series, "eval_ts", "value", "breach"]
    touched = late.select(*series).distinct()
    again = lookup_join(known.select(columns), touched, series, "left_semi", nulls_match=True)
    newest = F.max(F.struct("__late", "value", "breach")).alias("e")
    both = again.withColumn("__late", F.lit(0)).unionByName(
        late.where("eval_ts IS NOT NULL").withColumn("__late", F.lit(1))
    )
    once = both.groupBy(*series, "eval_ts").agg(newest).select(*series, "eval_ts", "e.value", "e.breach")
    corrected = alert_states(once, series, step_s, hold_s)
    others = lookup_join(known, touched, series, "left_anti", nulls_match=True)
    return others.unionByName(corrected.select(others.columns))


def _last_word(states: DataFrame, series: list[str]) -> DataFrame:
    rest = [c for c in states.columns if c not in series and c not in ("eval_ts", "batch_id")]
    last = F.max_by(F.struct(*rest), "batch_id").alias("s")
    newest = states.groupBy(*series, "eval_ts").agg(last, F.max("batch_id").alias("batch_id"))
    return newest.select(*series, "eval_ts", *[F.col("s")[c].alias(c) for c in rest], "batch_id")


def _state_parts(spark: SparkSession, path: str, checkpoint: str, series: list[str]) -> Parts:
    return Parts(spark, f"{path}/states", checkpoint, lambda rows: _last_word(rows, series))


def latest_states(spark: SparkSession, path: str, series: list[str], checkpoint: str) -> DataFrame:
    """The newest state of each evaluation that ``alert_state_stream`` has stored."""
    return _last_word(_state_parts(spark, path, checkpoint, series).read(), series).drop("batch_id")
