"""The alert rules: what each one measures, its limit, and how long it must hold."""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions.joins import union_all
from opsledger.functions.text import duration_text, matches_whole, percent_text
from opsledger.functions.timegrid import sliding_sums
from opsledger.functions.workspace import stored
from opsledger.operators.alerts import alert_states
from opsledger.operators.counters import counter_increase
from opsledger.operators.gauges import gauge_ratio, latest_sample
from opsledger.operators.histograms import bucket_counts, latency_quantile, quantile_of_counts
from opsledger.operators.ratios import SERVER_ERROR, error_ratio, publishing_counts

SERIES = ["alert", "labels"]
LOOKBACK_S = 300
EVAL_STEP_S = 30


@dataclass(frozen=True)
class AlertRule:
    alert: str
    severity: str
    compare: str
    limit: float
    range_s: int
    hold_s: int
    summary: str
    description: str


# Names, severities, limits, ranges, hold times and summaries of the rules.
SERVICE_DOWN = AlertRule(
    "ServiceDown", "critical", "=", 0.0, LOOKBACK_S, 60,
    "{job} is down", "The metrics of {job} cannot be read.",
)
HIGH_ERROR_RATE = AlertRule(
    "HighErrorRate", "critical", ">", 0.05, 300, 120,
    "High error rate on {job}", "Server errors are {value:percent} of the requests to {job}.",
)
HIGH_LATENCY = AlertRule(
    "HighLatency", "warning", ">", 2.0, 300, 300,
    "High p95 latency on {job}", "95% of the requests to {job} take up to {value:duration}.",
)
EVENT_PUBLISHING_FAILING = AlertRule(
    "EventPublishingFailing", "critical", ">", 0.0, 300, 300,
    "{job} is creating orders but not publishing events", "{value} orders led to no event.",
)
POD_CRASH_LOOPING = AlertRule(
    "PodCrashLooping", "critical", ">", 3.0, 900, 300,
    "{namespace}/{pod} is crash looping", "{pod} has restarted {value} times.",
)
POD_NOT_READY = AlertRule(
    "PodNotReady", "warning", "=", 0.0, LOOKBACK_S, 300,
    "{namespace}/{pod} is not ready", "{pod} has not been ready for some time.",
)
CRON_JOB_FAILED = AlertRule(
    "CronJobFailed", "warning", ">", 0.0, LOOKBACK_S, 0,
    "{job_name} failed", "The last run of {job_name} failed.",
)
VOLUME_FILLING_UP = AlertRule(
    "PersistentVolumeFillingUp", "warning", "<", 0.15, LOOKBACK_S, 300,
    "{persistentvolumeclaim} is filling up",
    "{value:percent} of the volume {persistentvolumeclaim} is free.",
)
RULES = (
    SERVICE_DOWN,
    HIGH_ERROR_RATE,
    HIGH_LATENCY,
    EVENT_PUBLISHING_FAILING,
    POD_CRASH_LOOPING,
    POD_NOT_READY,
    CRON_JOB_FAILED,
    VOLUME_FILLING_UP,
)

_PLACEHOLDER = re.compile(r"\{(\w+)(?::(\w+))?\}")


def annotation(template: str, value: Column, labels: list[str]) -> Column:
    """Text with ``{label}``, ``{value}``, ``{value:percent}`` or ``{value:duration}``.

    A label that the series does not have, or that is null, reads as empty text.
    """
    parts, end = [], 0
    for found in _PLACEHOLDER.finditer(template):
        parts.append(F.lit(template[end : found.start()]))
        name, style = found.groups()
        if name != "value":
            shown = F.col(name).cast("string") if name in labels else F.lit("")
        elif style == "percent":
            shown = percent_text(value)
        elif style == "duration":
            shown = duration_text(value)
        else:
            shown = F.regexp_replace(F.format_string("%.3f", value), r"\.?0+$", "")
        parts.append(F.coalesce(shown, F.lit("")))
        end = found.end()
    return F.concat(*parts, F.lit(template[end:]))


def evaluations(rule: AlertRule, series: DataFrame, labels: list[str], value: str) -> DataFrame:
    """Bring a windowed series into the common shape; an undefined value is no breach.

    Every row is one evaluation, at the end of its window.
    """
    measured = F.col(value).cast("double")
    limit = F.lit(rule.limit)
    breach = {"=": measured == limit, ">": measured > limit, "<": measured < limit}[rule.compare]
    return series.select(
        F.lit(rule.alert).alias("alert"),
        F.lit(rule.severity).alias("severity"),
        F.to_json(F.struct(*labels)).alias("labels"),
        F.col("window_end").alias("eval_ts"),
        measured.alias("value"),
        F.coalesce(breach, F.lit(False)).alias("breach"),
        F.lit(rule.hold_s).alias("hold_s"),
        annotation(rule.summary, measured, labels).alias("summary"),
        annotation(rule.description, measured, labels).alias("description"),
    )


def of_latest(rule: AlertRule, latest: DataFrame, labels: list[str], **patterns) -> DataFrame:
    """A rule on the latest samples; ``patterns`` are label regex matchers."""
    chosen = latest
    for label, pattern in patterns.items():
        chosen = chosen.where(matches_whole(label, pattern))
    return evaluations(rule, chosen, labels, "value")


def _sampled(rule, samples, labels, step_s, **patterns) -> DataFrame:
    latest = latest_sample(samples, labels, rule.range_s, step_s)
    return of_latest(rule, latest, labels, **patterns)


def service_down(up, labels, step_s=EVAL_STEP_S, rule=SERVICE_DOWN, **patterns) -> DataFrame:
    return _sampled(rule, up, labels, step_s, **patterns)


def pod_not_ready(ready, labels, step_s=EVAL_STEP_S, rule=POD_NOT_READY, **patterns) -> DataFrame:
    return _sampled(rule, ready, labels, step_s, **patterns)


def cron_job_failed(failed, labels, step_s=EVAL_STEP_S, rule=CRON_JOB_FAILED, **patterns) -> DataFrame:
    return _sampled(rule, failed, labels, step_s, **patterns)


def volume_filling_up(
    volumes, labels, available, capacity, step_s=EVAL_STEP_S, rule=VOLUME_FILLING_UP
) -> DataFrame:
    series = gauge_ratio(volumes, labels, available, capacity, rule.range_s, step_s)
    return evaluations(rule, series, labels, "ratio")


def high_error_rate(requests, labels, step_s=EVAL_STEP_S, rule=HIGH_ERROR_RATE) -> DataFrame:
    series = error_ratio(requests, labels, "ts", rule.range_s, step_s)
    return evaluations(rule, series, labels, "ratio")


def high_latency(requests, labels, step_s=EVAL_STEP_S, rule=HIGH_LATENCY, q=0.95) -> DataFrame:
    series = latency_quantile(
        requests, labels, "duration_seconds", q, "ts", rule.range_s, step_s
    )
    return evaluations(rule, series, labels, "quantile")


def request_rules(
    requests,
    labels,
    step_s=EVAL_STEP_S,
    error_rule=HIGH_ERROR_RATE,
    latency_rule=HIGH_LATENCY,
    q=0.95,
) -> list[DataFrame]:
    """Both rules on requests from one pass, if they look back equally far."""
    if error_rule.range_s != latency_rule.range_s:
        raise ValueError("the two rules have different ranges; evaluate them one by one")
    sums = {
        **bucket_counts("duration_seconds"),
        "n_errors": F.count_if(matches_whole("status_code", SERVER_ERROR)),
        "n_all": F.count("*"),
    }
    windows = sliding_sums(requests, labels, "ts", error_rule.range_s, step_s, sums).select(
        *labels,
        "window_end",
        F.try_divide("n_errors", "n_all").alias("ratio"),
        quantile_of_counts(q).alias("quantile"),
    )
    kept = stored(windows, "request-windows")
    return [
        evaluations(error_rule, kept, labels, "ratio"),
        evaluations(latency_rule, kept, labels, "quantile"),
    ]


def event_publishing_failing(
    events, labels, step_s=EVAL_STEP_S, rule=EVENT_PUBLISHING_FAILING
) -> DataFrame:
    """The value is the number of created orders in a window without any event."""
    series = publishing_counts(events, labels, "ts", rule.range_s, step_s)
    silent = F.when(F.col("published") == 0, F.col("created")).otherwise(0)
    return evaluations(rule, series.withColumn("silent", silent), labels, "silent")


def pod_crash_looping(restarts, labels, step_s=EVAL_STEP_S, rule=POD_CRASH_LOOPING) -> DataFrame:
    series = counter_increase(restarts, labels, rule.range_s, step_s)
    return evaluations(rule, series, labels, "increase")


def alert_table(evaluated: list[DataFrame], step_s: int = EVAL_STEP_S) -> DataFrame:
    """States of any number of rules, held in one pass over all their evaluations."""
    return alert_states(union_all(evaluated), SERIES, step_s, "hold_s").drop("breach", "hold_s")
