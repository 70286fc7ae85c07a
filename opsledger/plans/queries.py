"""The registered queries, each over whole tables of one test data folder."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions import text
from opsledger.functions.joins import union_all
from opsledger.functions.timegrid import BUCKET, WINDOW_KEYS, in_last, with_bucket
from opsledger.functions.workspace import new_folder, stored
from opsledger.operators import (
    alerts,
    cardinality,
    counters,
    events as ev,
    gauges,
    histograms,
    logs as lg,
    order_counts,
    orders as od,
    quality,
    quantiles,
    ratios,
    skip_index,
    topics,
)
from opsledger.plans import alert_rules as ar
from opsledger.plans import views as v
from opsledger.sinks.exposition import counter_lines, histogram_lines
from opsledger.sources import logs as log_source
from opsledger.sources.messages import (
    dead_letters,
    decode_messages,
    encode_events,
    good_messages,
)
from opsledger.sources.samples import malformed_samples, parse_samples
from opsledger.streaming import pipelines

Query = Callable[[SparkSession, str], DataFrame]

# The test data is sparse, so windows and limits are wider than the rules' own.
AS_OF = datetime(1998, 1, 8)
RANGE_S = 6 * 3600
STEP_S = 3600
HOLD_S = 3 * 3600
ERROR_LIMIT = 0.2
LATENCY_LIMIT = 1.5

_REGISTRY: dict[str, Query] = {}


def _register(query: Query) -> Query:
    _REGISTRY[query.__name__] = query
    return query


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "events")


# Orders


@_register
def orders_scan(spark, sf):
    return v.fx_orders(spark, sf)


@_register
def orders_in_period(spark, sf):
    return od.orders_in_period(v.fx_orders(spark, sf), datetime(1998, 1, 1), AS_OF)


@_register
def order_summary(spark, sf):
    return od.order_summary(v.fx_orders(spark, sf), as_of=AS_OF)


@_register
def report_json(spark, sf):
    return od.report_document(order_summary(spark, sf)).select(
        "period_start",
        "period_end",
        "total_orders",
        *[F.col(f"by_status.{s}").alias(s) for s in ("pending", "confirmed", "cancelled")],
    )


@_register
def report_long(spark, sf):
    return od.report_long(order_summary(spark, sf)).select("ordinal", "metric", "value")


@_register
def report_shares(spark, sf):
    return od.status_shares(od.sliding_summary(v.fx_orders(spark, sf)))


@_register
def report_html(spark, sf):
    return od.report_html(od.sliding_summary(v.fx_orders(spark, sf)))


@_register
def report_sliding(spark, sf):
    return od.sliding_summary(v.fx_orders(spark, sf))


@_register
def report_incremental(spark, sf):
    """Orders stored in two steps by month; the second refresh counts the months that changed."""
    folder = new_folder(spark, "report-incremental")
    orders = v.fx_orders(spark, sf).select("created_at", "status", F.date_format("created_at", "yyyy-MM").alias("month"))
    recent = F.col("created_at") >= F.lit("1998-01-01").cast("timestamp_ntz")
    for part in (orders.where(~recent), orders.where(recent)):
        part.hint("rebalance", "month").write.partitionBy("month").mode("append").parquet(f"{folder}/orders")
        kept = spark.read.parquet(f"{folder}/orders")
        order_counts.refresh_counts(spark, kept, f"{folder}/orders", f"{folder}/counts", partition="month")
    return order_counts.kept_summary(spark, f"{folder}/counts")


@_register
def report_weekly(spark, sf):
    """Weekly on Monday at 06:00."""
    week = 7 * od.DAY_S
    return od.sliding_summary(v.fx_orders(spark, sf), week, week, 4 * od.DAY_S + 6 * 3600)


@_register
def orders_lookup(spark, sf):
    return od.lookup_orders(v.fx_keys(spark, sf), v.fx_orders(spark, sf))


@_register
def orders_ingest_valid(spark, sf):
    return od.validate_requests(v.fx_order_requests(spark, sf)).select(
        "customer_id", "product_id", "quantity", "status", "accepted", "reason"
    )


@_register
def orders_rejected(spark, sf):
    return od.rejected_requests(v.fx_order_requests(spark, sf)).select(
        "customer_id", "product_id", "quantity", "status", "reason"
    )


@_register
def orders_append(spark, sf):
    return od.new_orders(v.fx_order_requests(spark, sf)).select(
        "customer_id", "product_id", "quantity", "status"
    )


@_register
def scalar_formats(spark, sf):
    moment = F.col("created_at") + F.make_dt_interval(secs=F.col("quantity") / 8)
    half = F.col("quantity") * F.lit(0.5)
    return v.fx_orders(spark, sf).select(
        "id",
        text.iso_timestamp(moment).alias("iso"),
        F.to_date(moment).alias("day"),
        text.minute_label(moment).alias("minute"),
        (F.col("created_at") - F.make_dt_interval(days=F.lit(7))).alias("week_before"),
        text.bar_width(half).alias("bar"),
        text.round_duration(F.col("quantity") / F.lit(7)).alias("rounded"),
    )


@_register
def text_escape(spark, sf):
    """Whole pages as text for a report; their escaped forms are compared by checksum."""
    escaped = text.html_escape(F.coalesce("html", F.lit("")))
    return v.table(spark, sf, "pages").select("page_id", F.sha2(escaped, 256).alias("escaped_sha256"))


@_register
def dq_not_null(spark, sf):
    return quality.null_counts(v.fx_orders(spark, sf))


@_register
def dq_unique(spark, sf):
    return quality.uniqueness(v.fx_orders(spark, sf))


@_register
def dq_duplicates(spark, sf):
    return quality.duplicate_keys(v.fx_redelivered(_events(spark, sf)), "event_id")


@_register
def dq_status_domain(spark, sf):
    return quality.domain_counts(v.fx_orders(spark, sf))


# Events


@_register
def events_encode(spark, sf):
    """Encodes every event and reads the fields back from the text."""
    body = encode_events(v.fx_events(_events(spark, sf)))
    return body.select(
        "event_id",
        "routing_key",
        *[
            F.get_json_object("body", f"$.{path}").alias(name)
            for name, path in (
                ("event_type", "event_type"),
                ("order_id", "payload.order_id"),
                ("customer_id", "payload.customer_id"),
            )
        ],
    )


@_register
def events_decode(spark, sf):
    good = good_messages(decode_messages(v.fx_messages(_events(spark, sf))))
    return good.select(
        "event_id",
        "ts",
        "event_type",
        F.try_element_at("payload", F.lit("order_id")).alias("order_id"),
        text.map_get("payload", "customer_id", "").alias("customer_id"),
    )


@_register
def dead_letter(spark, sf):
    return dead_letters(decode_messages(v.fx_messages(_events(spark, sf))))


@_register
def routing_rules(spark, sf):
    """Each rule entry with the number of events that reach it."""
    return ev.rule_usage(v.fx_events(_events(spark, sf)), *v.rules(spark))


@_register
def route_events(spark, sf):
    found = v.fx_events(_events(spark, sf))
    return ev.route_events(found, *v.rules(spark), is_small=True).select(
        "event_id", "event_type", "pos", "channel", "template", "retry", "level"
    )


@_register
def notifications(spark, sf):
    """From message text to notification rows, payload included."""
    good = good_messages(decode_messages(v.fx_messages(_events(spark, sf))))
    return ev.route_events(good, *v.rules(spark), is_small=True).select(
        "event_id",
        "event_type",
        "pos",
        "channel",
        "template",
        text.map_get("payload", "order_id", "").alias("order_id"),
    )


@_register
def topic_subscribe(spark, sf):
    """Events per type that queues bound with different patterns receive."""
    counts = counters.label_counts(v.fx_events(_events(spark, sf)), ["event_type"], "n_events")
    patterns = ("#", "order.*", "*.created", "order.c*", "#.shipped", "order")
    bound = [
        ev.subscribe(counts, p).select(F.lit(p).alias("pattern"), "event_type", "n_events")
        for p in patterns
    ]
    return union_all(bound)


@_register
def topic_bindings(spark, sf):
    """Messages per binding, of 125 bindings at once."""
    found = topics.subscribed(v.fx_topics(_events(spark, sf)), v.fx_bindings(spark, sf))
    return found.groupBy("binding", "pattern").agg(F.count("*").alias("n"))


@_register
def order_topic(spark, sf):
    return ev.subscribe(v.fx_events(_events(spark, sf)), "*.created").select(
        "event_id", "event_type"
    )


@_register
def message_counts(spark, sf):
    return ev.message_counts(v.fx_deliveries(_events(spark, sf), spark))


@_register
def delivery_attempts(spark, sf):
    return ev.delivery_attempts(v.fx_attempts(_events(spark, sf), spark)).select(
        "event_id",
        "channel",
        "retry",
        "attempts_needed",
        "attempts_made",
        "delivered",
        "dead_letter",
    )


@_register
def events_dedup(spark, sf):
    """Over decoded messages, payload map included."""
    decoded = good_messages(decode_messages(v.fx_messages(_events(spark, sf))))
    copies = decoded.unionByName(decoded.where("event_id % 10 = 0"))
    return ev.first_deliveries(copies).select(
        "event_id",
        "ts",
        "event_type",
        F.try_element_at("payload", F.lit("order_id")).alias("order_id"),
    )


@_register
def orders_without_event(spark, sf):
    event_orders = v.fx_events(_events(spark, sf)).select(
        F.try_element_at("payload", F.lit("order_id")).alias("order_id")
    )
    return ev.reconcile(v.fx_orders(spark, sf), event_orders)


@_register
def event_rate(spark, sf):
    return counters.event_rate(
        v.fx_events(_events(spark, sf)), ["event_type"], "ts", RANGE_S, STEP_S
    )


@_register
def received_vs_processed(spark, sf):
    """Messages, not channels; a window in which nothing was processed has ratio 0."""
    messages = v.fx_deliveries(_events(spark, sf), spark)
    shares = ratios.windowed_ratio(
        messages, ["event_type"], ev.is_processed(), "ts", RANGE_S, STEP_S
    )
    return shares.select(
        "event_type", *WINDOW_KEYS, F.round("ratio", 9).alias("ratio")
    )


@_register
def published_per_created(spark, sf):
    """The rate of one series over the rate of another with equal labels."""
    raw = _events(spark, sf)
    on = ["job", *WINDOW_KEYS]

    def rate(rows):
        return counters.event_rate(rows, ["job"], "ts", RANGE_S, STEP_S)

    published = rate(v.fx_published(raw).where("kind = 'published'"))
    created = rate(v.fx_requests(raw).where("method = 'POST'"))
    both = ratios.series_ratio(published, created, on, "rate")
    return both.select(*on, F.round("ratio", 9).alias("ratio"))


# Requests


@_register
def request_counts(spark, sf):
    return counters.label_counts(
        v.fx_requests(_events(spark, sf)), ["method", "path", "status_code"]
    )


@_register
def latency_histogram(spark, sf):
    return histograms.latency_histogram(
        v.fx_requests(_events(spark, sf)), ["method", "path"], "duration_seconds"
    ).withColumn("observed_sum", F.round("observed_sum", 4))


@_register
def metrics_text(spark, sf):
    """Request counters and latency buckets in the text form."""
    requests = v.fx_requests(_events(spark, sf))
    labels = ["method", "path", "status_code"]
    counts = counters.label_counts(requests, labels)
    histogram = histograms.latency_histogram(requests, labels[:2], "duration_seconds")
    kinds = [
        counter_lines(counts, "requests_total", labels),
        histogram_lines(
            histogram.withColumn("observed_sum", F.round("observed_sum")),
            "request_duration_seconds",
            labels[:2],
        ),
    ]
    return union_all(kinds)


@_register
def histogram_quantile(spark, sf):
    """From the rows of a windowed histogram, as a bucket series would give them."""
    buckets = histograms.windowed_histogram(
        v.fx_requests(_events(spark, sf)), ["job"], "duration_seconds", "ts", RANGE_S, STEP_S
    )
    found = histograms.histogram_quantile(buckets, ["job", *WINDOW_KEYS], 0.95)
    return found.withColumn("quantile", F.round("quantile", 9))


@_register
def latency_quantile(spark, sf):
    found = histograms.latency_quantile(
        v.fx_requests(_events(spark, sf)), ["job"], "duration_seconds", 0.95, "ts", RANGE_S, STEP_S
    )
    return found.withColumn("quantile", F.round("quantile", 9))


def _weighted(spark, sf, step_s):
    rows = with_bucket(v.fx_weighted(_events(spark, sf)), "ts", step_s)
    return stored(rows.groupBy("job", BUCKET, "v").agg(F.sum("w").alias("w")), "weighted-values")


@_register
def latency_weighted_quantile(spark, sf):
    """Exact, by summaries of step buckets and a bracket for each window."""
    found = quantiles.windowed_quantile(
        _weighted(spark, sf, STEP_S), ["job"], 0.95, RANGE_S, STEP_S, small_group=0, points=16
    )
    return found.withColumn("quantile", F.round("quantile", 6))


@_register
def latency_summary(spark, sf):
    """Cut points per job and day, which is all that later windows need to bound a quantile."""
    return quantiles.quantile_summary(_weighted(spark, sf, od.DAY_S), ["job", BUCKET], points=16)


@_register
def error_ratio(spark, sf):
    return ratios.error_ratio(v.fx_requests(_events(spark, sf)), ["job"], "ts", RANGE_S, STEP_S)


@_register
def series_cardinality(spark, sf):
    """Label sets per job, with the path template and with the raw path as label."""
    raw = _events(spark, sf)
    requests = v.fx_requests(raw).select("job", "method", "path", "status_code")
    by_template = counters.series_cardinality(
        requests.withColumn("metric", F.lit("requests_total")),
        "metric",
        ["job", "method", "path", "status_code"],
    )
    by_id = counters.series_cardinality(
        raw.select(
            F.lit("requests_by_raw_path_total").alias("metric"),
            F.concat(F.lit("/orders/"), F.col("event_id").cast("string")).alias("path"),
        ),
        "metric",
        ["path"],
    )
    return by_template.unionByName(by_id)


_SERIES = ["method", "status_code", "path"]


@_register
def windowed_cardinality(spark, sf):
    """Label sets of each job in sliding windows, from stored states of an hour."""
    requests = v.fx_requests(_events(spark, sf))
    states = stored(cardinality.label_states(requests, ["job"], _SERIES, STEP_S), "label-states")
    return cardinality.windowed_cardinality(states, ["job"], RANGE_S, STEP_S)


@_register
def label_regex_filter(spark, sf):
    return v.fx_requests(_events(spark, sf)).where(lg.label_matches(status_code="4..|5..", job="svc-[0-3]"))


@_register
def publishing_stalled(spark, sf):
    return ratios.publishing_stalled(
        v.fx_published(_events(spark, sf)), ["job"], "ts", RANGE_S, STEP_S
    )


@_register
def created_and_failing(spark, sf):
    """Windows of a job in which orders were created and some request failed."""
    requests = v.fx_requests(_events(spark, sf))
    on = ["job", *WINDOW_KEYS]

    def rate(code):
        return counters.event_rate(
            requests.where(F.col("status_code") == code), ["job"], "ts", RANGE_S, STEP_S
        )

    return ratios.series_and(rate("201"), rate("500"), on)


# Samples


@_register
def samples_parse(spark, sf):
    """Some samples have their own time; broken lines are left to ``samples_malformed``."""
    parsed = parse_samples(v.fx_scrape_mixed(_events(spark, sf)))
    return parsed.select(
        "ts",
        "metric",
        text.map_get("labels", "job", "").alias("job"),
        text.map_get("labels", "status_code", "").alias("status_code"),
        "value",
    )


@_register
def samples_malformed(spark, sf):
    bad = malformed_samples(v.fx_scrape_mixed(_events(spark, sf)))
    return bad.select("ts", F.substring_index("line", " ", 1).alias("name_and_labels"))


@_register
def log_lines_escape(spark, sf):
    """User text with quotes, backslashes and breaks, written as a log line and read back."""
    raw = _events(spark, sf)
    said = F.concat(F.lit('he said "'), F.col("event_type"), F.lit('"\\ \n\t'), F.col("user_id").cast("string"))
    line = text.log_line(F.col("ts"), F.lit("INFO"), F.lit("src.main"), said)
    parsed = log_source.parse_log_json(raw.select("event_id", "ts", line.alias("line")))
    return parsed.select("event_id", "fields.message")


_COUNTER = ["job", "status_code"]


@_register
def counter_delta(spark, sf):
    return counters.counter_deltas(v.fx_counter(_events(spark, sf)), _COUNTER)


@_register
def counter_rate(spark, sf):
    rates = counters.counter_rate(v.fx_counter(_events(spark, sf)), _COUNTER, RANGE_S, STEP_S)
    return rates.withColumn("rate", F.round("rate", 9))


@_register
def restart_increase(spark, sf):
    return counters.counter_increase(v.fx_counter(_events(spark, sf)), _COUNTER, RANGE_S, STEP_S)


@_register
def latest_sample(spark, sf):
    return gauges.latest_sample(
        v.fx_gauge(_events(spark, sf)), ["metric", "job"], RANGE_S, STEP_S
    )


@_register
def volume_free_ratio(spark, sf):
    return gauges.gauge_ratio(
        v.fx_gauge(_events(spark, sf)),
        ["job"],
        "volume_available",
        "volume_capacity",
        RANGE_S,
        STEP_S,
    )


@_register
def cpu_utilisation(spark, sf):
    usage = v.fx_gauge(_events(spark, sf)).where("metric = 'cpu_usage'")
    means = gauges.utilisation(
        usage.withColumn("requested", F.lit(100.0)), ["job"], RANGE_S, STEP_S
    )
    return means.withColumn("utilisation_pct", F.round("utilisation_pct", 9))


# Alerts


def _rule(rule: ar.AlertRule, limit: float | None = None, hold_s: int = HOLD_S) -> ar.AlertRule:
    return ar.AlertRule(
        rule.alert,
        rule.severity,
        rule.compare,
        rule.limit if limit is None else limit,
        RANGE_S,
        hold_s,
        rule.summary,
        rule.description,
    )


def _shown(states: DataFrame) -> DataFrame:
    """All that a stored alert has, values rounded."""
    return states.select(
        "alert",
        "severity",
        "labels",
        "eval_ts",
        F.round("value", 6).alias("value"),
        "active_since",
        "state",
        "summary",
        "description",
    )


def _error_rate(spark, sf):
    return ar.high_error_rate(
        v.fx_requests(_events(spark, sf)), ["job"], STEP_S, _rule(ar.HIGH_ERROR_RATE, ERROR_LIMIT)
    )


@_register
def alert_states(spark, sf):
    return _shown(ar.alert_table([_error_rate(spark, sf)], STEP_S))


_POD = ["namespace", "pod"]


def _with_labels(series: DataFrame) -> DataFrame:
    """The labels of pods, jobs and volumes, one of each per service."""
    job = F.col("job")
    return series.withColumns(
        {
            "namespace": F.lit("shop"),
            "pod": F.concat(job, F.lit("-0")),
            "job_name": F.concat(F.lit("report-"), job),
            "persistentvolumeclaim": F.concat(F.lit("data-"), job),
        }
    )


def _evaluated(spark, sf) -> dict[str, Callable[[], list[DataFrame]]]:
    """The evaluations of each rule, or of two that share a pass over the requests."""
    raw = _events(spark, sf)

    def of(metric):
        gauge = v.fx_gauge(raw).where(F.col("metric") == metric).drop("pod")
        return _with_labels(gauges.latest_sample(gauge, ["metric", "job"], RANGE_S, STEP_S))

    def volumes():
        free = gauges.gauge_ratio(
            v.fx_gauge(raw), ["job"], "volume_available", "volume_capacity", RANGE_S, STEP_S
        )
        return _with_labels(free)

    def latest(rule, metric, labels, **options):
        patterns = options.pop("patterns", {})
        return lambda: [ar.of_latest(_rule(rule, **options), of(metric), labels, **patterns)]

    def restarts():
        series = _with_labels(v.fx_counter(raw))
        return [
            ar.pod_crash_looping(series, [*_POD, "status_code"], STEP_S, _rule(ar.POD_CRASH_LOOPING))
        ]

    return {
        "service_down": latest(ar.SERVICE_DOWN, "up", ["job"], patterns={"job": "svc-.*"}),
        "high_error_rate": lambda: [_error_rate(spark, sf)],
        "high_latency": lambda: [
            ar.high_latency(
                v.fx_requests(raw), ["job"], STEP_S, _rule(ar.HIGH_LATENCY, LATENCY_LIMIT)
            )
        ],
        "event_publishing_failing": lambda: [
            ar.event_publishing_failing(
                v.fx_published(raw), ["job"], STEP_S, _rule(ar.EVENT_PUBLISHING_FAILING)
            )
        ],
        "pod_crash_looping": restarts,
        "pod_not_ready": latest(ar.POD_NOT_READY, "pod_ready", _POD),
        "cron_job_failed": latest(ar.CRON_JOB_FAILED, "job_failed", ["job_name"], hold_s=0),
        "volume_filling_up": lambda: [
            ar.evaluations(
                _rule(ar.VOLUME_FILLING_UP), volumes(), ["persistentvolumeclaim"], "ratio"
            )
        ],
    }


def _register_rule(name: str) -> None:
    def query(spark, sf):
        return _shown(ar.alert_table(_evaluated(spark, sf)[name](), STEP_S))

    query.__name__ = f"alert_{name}"
    _register(query)


RULE_NAMES = (
    "service_down",
    "high_error_rate",
    "high_latency",
    "event_publishing_failing",
    "pod_crash_looping",
    "pod_not_ready",
    "cron_job_failed",
    "volume_filling_up",
)
for _name in RULE_NAMES:
    _register_rule(_name)


@_register
def alert_rules(spark, sf):
    """All eight rules, held in one pass; gauges and requests are read once each."""
    raw = _events(spark, sf)
    gauge = v.fx_gauge(raw).drop("pod")
    latest = stored(gauges.latest_sample(gauge, ["metric", "job"], RANGE_S, STEP_S), "latest")

    def of(metric):
        return _with_labels(latest.where(F.col("metric") == metric))

    free = gauges.latest_ratio(latest, ["job"], "volume_available", "volume_capacity")
    rules = _evaluated(spark, sf)
    return _shown(
        ar.alert_table(
            [
                ar.of_latest(_rule(ar.SERVICE_DOWN), of("up"), ["job"], job="svc-.*"),
                *ar.request_rules(
                    v.fx_requests(raw),
                    ["job"],
                    STEP_S,
                    _rule(ar.HIGH_ERROR_RATE, ERROR_LIMIT),
                    _rule(ar.HIGH_LATENCY, LATENCY_LIMIT),
                ),
                *rules["event_publishing_failing"](),
                *rules["pod_crash_looping"](),
                ar.of_latest(_rule(ar.POD_NOT_READY), of("pod_ready"), _POD),
                ar.of_latest(_rule(ar.CRON_JOB_FAILED, hold_s=0), of("job_failed"), ["job_name"]),
                ar.evaluations(
                    _rule(ar.VOLUME_FILLING_UP), _with_labels(free), ["persistentvolumeclaim"], "ratio"
                ),
            ],
            STEP_S,
        )
    )


# Logs


def _logs(spark, sf):
    return v.fx_logs(_events(spark, sf))


def _enriched(spark, sf):
    targets = log_source.pod_targets(v.fx_pods(spark, sf))
    return lg.enrich(log_source.with_file_keys(_logs(spark, sf)), targets)


_LINE_KEYS = ["ts", "namespace", "pod", "container", "app"]


def _lines(rows: DataFrame) -> DataFrame:
    return rows.select(*_LINE_KEYS, text.trace_id("line").alias("trace_id"))


@_register
def log_scan(spark, sf):
    parsed = log_source.parse_log_json(log_source.with_file_keys(_logs(spark, sf)))
    return parsed.select(
        "ts",
        "uid",
        "container",
        "fields.time",
        "fields.level",
        "fields.message",
        "fields.status_code",
        "line",
    )


@_register
def pod_targets(spark, sf):
    return log_source.pod_targets(v.fx_pods(spark, sf))


@_register
def logs_enriched(spark, sf):
    return _lines(_enriched(spark, sf))


@_register
def log_label_filter(spark, sf):
    return _lines(_enriched(spark, sf).where(lg.label_is(namespace="ASIA", app="svc-2")))


@_register
def log_line_filter(spark, sf):
    wanted = lg.line_contains("ERROR") | ~lg.line_contains("/health")
    return _lines(_enriched(spark, sf).where(wanted))


@_register
def log_line_regex(spark, sf):
    return _lines(_enriched(spark, sf).where(lg.line_matches("timeout|connection refused")))


@_register
def log_json_filter(spark, sf):
    parsed = log_source.parse_log_json(_enriched(spark, sf))
    return _lines(
        parsed.where(
            lg.json_equals("level", "error", ignore_case=True) & lg.json_at_least("status_code", 500)
        )
    )


@_register
def log_error_rate(spark, sf):
    return lg.line_rate(
        _enriched(spark, sf), ["app"], RANGE_S, STEP_S, where=lg.line_contains("ERROR")
    )


@_register
def log_volume(spark, sf):
    return lg.line_rate(
        _enriched(spark, sf), ["namespace"], RANGE_S, STEP_S, where=lg.label_matches(app=".+")
    )


@_register
def log_quantile(spark, sf):
    found = lg.field_quantile(
        _enriched(spark, sf), ["app"], "duration_seconds", 0.95, RANGE_S, STEP_S
    )
    return found.withColumn("quantile", F.round("quantile", 6))


@_register
def log_quantile_by_app(spark, sf):
    """Over the whole log, where one app can hold a large part of all lines."""
    found = lg.field_quantile(
        _enriched(spark, sf), ["app"], "duration_seconds", 0.95, 30 * od.DAY_S, 30 * od.DAY_S
    )
    return found.withColumn("quantile", F.round("quantile", 6))


@_register
def log_search(spark, sf):
    """Log files by pod, indexed, and two searches that open only files that may match."""
    folder = new_folder(spark, "log-search")
    lines = _logs(spark, sf).select(F.regexp_extract("path", "pods/([0-9]+)/", 1).alias("uid"), "line")
    lines.hint("rebalance", "uid").write.partitionBy("uid").text(f"{folder}/logs")
    glob = f"{folder}/logs/*/*.txt"
    skip_index.build_index(spark, glob).write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    found = {
        "text": skip_index.search(spark, glob, index, text='"trace_id":"77"'),
        "regex": skip_index.search(spark, glob, index, regex='(order created|timeout).*"trace_id":"[0-9]?[0-9]7"'),
    }
    return union_all([df.select(F.lit(name).alias("search"), "line") for name, df in found.items()])


@_register
def log_tail(spark, sf):
    return lg.tail(_logs(spark, sf), [F.col("ts").desc(), F.col("line")]).select("ts", "line")


@_register
def log_tail_many(spark, sf):
    newest = [F.col("ts").desc(), F.col("line")]
    return lg.tail(_logs(spark, sf), newest, 3000, newest_by="ts").select("ts", "line")


@_register
def log_last_hours(spark, sf):
    return in_last(_logs(spark, sf), "ts", RANGE_S, datetime(2024, 1, 15, 12)).select("ts", "path")


@_register
def log_trace_id(spark, sf):
    return _logs(spark, sf).select("ts", text.trace_id("line").alias("trace_id"))


@_register
def alert_logs(spark, sf):
    """Error lines of an app, written while its error ratio made an alert fire."""
    on = ["namespace", "app"]
    enriched = _enriched(spark, sf)
    share = ratios.windowed_ratio(
        enriched, on, lg.line_contains("ERROR"), "ts", RANGE_S, STEP_S
    ).select(*on, F.col("window_end").alias("eval_ts"), (F.col("ratio") > ERROR_LIMIT).alias("breach"))
    states = alerts.alert_states(share, on, STEP_S, HOLD_S)
    intervals = alerts.firing_intervals(states, on)
    during = lg.logs_during(enriched.where(lg.line_contains("ERROR")), intervals, on)
    return during.select(
        *on, "start_ts", "end_ts", "ts", text.trace_id("line").alias("trace_id")
    )


# Streams


@_register
def stream_route(spark, sf):
    folder = new_folder(spark, "stream-route")
    messages = v.fx_messages(v.stream_table(spark, sf, "events"))
    pipelines.route_messages(
        messages, *v.rules(spark), f"{folder}/sent", f"{folder}/dead", f"{folder}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/sent").select(
        "event_id", "event_type", "pos", "channel", "template"
    )


@_register
def stream_dead_letter(spark, sf):
    folder = new_folder(spark, "stream-dead-letter")
    messages = v.fx_messages(v.stream_table(spark, sf, "events"))
    pipelines.route_messages(
        messages, *v.rules(spark), f"{folder}/sent", f"{folder}/dead", f"{folder}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/dead").select("event_id", "ts", "body", "body_head")


@_register
def stream_dedup(spark, sf):
    folder = new_folder(spark, "stream-dedup")
    copies = v.fx_redelivered(v.stream_table(spark, sf, "events"))
    pipelines.append_stream(
        pipelines.dedup_stream(copies), f"{folder}/out", f"{folder}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type"
    )


@_register
def stream_dedup_all(spark, sf):
    """Three micro-batches; copies come in a later one than the event."""
    folder = new_folder(spark, "stream-dedup-all")
    events = v.fx_events(_events(spark, sf)).drop("payload")
    third = F.col("event_id") % 3
    for i in range(3):
        again = events.where((F.col("event_id") % 10 == 0) & (third < i))
        events.where(third == i).unionByName(again).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    pipelines.dedup_all_stream(
        stream, f"{folder}/out", f"{folder}/checkpoint", same_time=True, buckets=2
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out/events").select("event_id", "ts", "event_type")


@_register
def stream_retry(spark, sf):
    """Into a sink that refuses a delivery until the attempt that it says it needs."""

    def send(frame):
        import json

        return [json.loads(b)["attempts_needed"] <= a for b, a in zip(frame["body"], frame["attempt"])]

    folder = new_folder(spark, "stream-retry")
    deliveries = v.fx_attempts(v.stream_table(spark, sf, "events"), spark)
    query = pipelines.delivery_stream(
        deliveries, send, f"{folder}/delivered", f"{folder}/dead", f"{folder}/checkpoint",
        backoff_s=(0.1,), shards=8, trigger={"processingTime": "100 milliseconds"},
    )
    pipelines.settle(query)
    both = [
        spark.read.parquet(f"{folder}/{side}").withColumn("delivered", F.lit(side == "delivered"))
        for side in ("delivered", "dead")
    ]
    return union_all(both).select("event_id", "channel", "attempts_made", "delivered")


@_register
def stream_event_rate(spark, sf):
    folder = new_folder(spark, "stream-rate")
    keys = ["event_type"]
    events = v.fx_events(v.stream_table(spark, sf, "events"))
    pipelines.event_rate_stream(
        events, keys, STEP_S, f"{folder}/buckets", f"{folder}/checkpoint"
    ).awaitTermination()
    buckets = pipelines.stored_buckets(spark, f"{folder}/buckets", f"{folder}/checkpoint")
    return pipelines.event_rates(buckets, keys, RANGE_S, STEP_S)


@_register
def stream_windows(spark, sf):
    """Windows that the watermark has closed, and the corrections that make them whole."""
    folder = new_folder(spark, "stream-windows")
    keys, counts = ["event_type"], {"n": F.count("*")}
    events = v.fx_events(v.stream_table(spark, sf, "events"))
    pipelines.window_stream(
        events, keys, counts, RANGE_S, STEP_S, f"{folder}/windows", f"{folder}/windows-checkpoint"
    ).awaitTermination()
    pipelines.bucket_stream(
        events, keys, counts, STEP_S, f"{folder}/buckets", f"{folder}/checkpoint"
    ).awaitTermination()
    buckets = pipelines.stored_buckets(spark, f"{folder}/buckets", f"{folder}/checkpoint")
    totals = pipelines.windows_of(buckets, keys, ["n"], RANGE_S, STEP_S)
    closed = spark.read.parquet(f"{folder}/windows")
    corrections = pipelines.window_corrections(closed, totals, keys, ["n"])
    return pipelines.corrected_windows(closed, corrections, keys, ["n"])


def _stream_ratios(spark, sf, folder):
    requests = v.fx_requests(v.stream_table(spark, sf, "events"))
    pipelines.error_ratio_stream(
        requests, ["job"], STEP_S, f"{folder}/buckets", f"{folder}/checkpoint"
    ).awaitTermination()
    buckets = pipelines.stored_buckets(spark, f"{folder}/buckets", f"{folder}/checkpoint")
    return pipelines.error_ratios(buckets, ["job"], RANGE_S, STEP_S)


@_register
def stream_cardinality(spark, sf):
    folder = new_folder(spark, "stream-labels")
    requests = v.fx_requests(v.stream_table(spark, sf, "events"))
    pipelines.label_state_stream(
        requests, ["job"], _SERIES, STEP_S, f"{folder}/states", f"{folder}/checkpoint"
    ).awaitTermination()
    states = pipelines.stored_buckets(spark, f"{folder}/states", f"{folder}/checkpoint")
    return cardinality.windowed_cardinality(states, ["job"], RANGE_S, STEP_S)


@_register
def stream_error_ratio(spark, sf):
    return _stream_ratios(spark, sf, new_folder(spark, "stream-ratio"))


@_register
def stream_alert_states(spark, sf):
    """The windows of the stream, read as a stream again; states come from all evaluations."""
    folder = new_folder(spark, "stream-alerts")
    shares = _stream_ratios(spark, sf, folder)
    evaluated = shares.select(
        "job",
        F.col("window_end").alias("eval_ts"),
        F.col("ratio").alias("value"),
        (F.col("ratio") > ERROR_LIMIT).alias("breach"),
    )
    evaluated.write.parquet(f"{folder}/evaluated")
    stream = spark.readStream.schema(evaluated.schema).parquet(f"{folder}/evaluated")
    checkpoint = f"{folder}/states-checkpoint"
    pipelines.alert_state_stream(
        stream, ["job"], STEP_S, HOLD_S, f"{folder}/alerts", checkpoint
    ).awaitTermination()
    states = pipelines.latest_states(spark, f"{folder}/alerts", ["job"], checkpoint)
    return states.select("job", "eval_ts", F.round("value", 6).alias("value"), "active_since", "state")
