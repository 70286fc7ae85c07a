import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsledger.operators import alerts
from opsledger.plans import alert_rules as ar
from opsledger.sinks.tables import append_alerts

T0 = datetime(2024, 1, 1)
EVAL = "s string, eval_ts timestamp_ntz, breach boolean"


def _at(step):
    return T0 + timedelta(seconds=30 * step)


def _states(spark, steps, hold_s, chunk_s=86400):
    rows = [("a", _at(i), b) for i, b in steps]
    found = alerts.alert_states(spark.createDataFrame(rows, EVAL), ["s"], 30, hold_s, chunk_s=chunk_s)
    return [r.state for r in found.orderBy("eval_ts").collect()]


P, F_, I = "pending", "firing", "inactive"


@pytest.mark.parametrize("chunk_s", [30, 60, 86400])
@pytest.mark.parametrize(
    "steps, hold_s, expected",
    [
        ([(0, True), (1, True)], 60, [P, P]),
        ([(0, True), (1, True), (2, True)], 60, [P, P, F_]),
        ([(0, True), (1, True), (2, False), (3, True), (4, True), (5, True)], 60, [P, P, I, P, P, F_]),
        ([(0, True), (1, True), (3, True), (4, True)], 60, [P, P, P, P]),
        ([(0, True), (1, None), (2, True)], 30, [P, I, P]),
        ([(0, True), (1, False)], 0, [F_, I]),
    ],
)
def test_hold(spark, steps, hold_s, expected, chunk_s):
    assert _states(spark, steps, hold_s, chunk_s) == expected


@pytest.mark.parametrize("chunk_s", [30, 90, 300, 86400])
def test_streaks_do_not_depend_on_chunks(spark, chunk_s):
    rng, rows, expected = random.Random(1), [], {}
    for s in "ab":
        since = last = None
        for i in range(400):
            if rng.random() < 0.03:
                continue
            breach = rng.random() < 0.9
            if not breach:
                since = None
            elif since is None or last != i - 1:
                since = _at(i)
            last = i
            rows.append((s, _at(i), breach))
            expected[s, _at(i)] = since
    rng.shuffle(rows)
    found = alerts.streaks(spark.createDataFrame(rows, EVAL), ["s"], 30, chunk_s=chunk_s)
    assert {(r.s, r.eval_ts): r.active_since for r in found.collect()} == expected


def test_intervals(spark):
    rows = [("a", _at(i), i not in (5, 20)) for i in range(30)]
    states = alerts.alert_states(spark.createDataFrame(rows, EVAL), ["s"], 30, 300)
    assert [(r.start_ts, r.end_ts) for r in alerts.firing_intervals(states, ["s"]).collect()] == [
        (_at(6), _at(19))]


def test_fixed_rule_values():
    assert [(r.alert, r.hold_s, r.limit) for r in ar.RULES] == [
        ("ServiceDown", 60, 0.0), ("HighErrorRate", 120, 0.05), ("HighLatency", 300, 2.0),
        ("EventPublishingFailing", 300, 0.0), ("PodCrashLooping", 300, 3.0), ("PodNotReady", 300, 0.0),
        ("CronJobFailed", 0, 0.0), ("PersistentVolumeFillingUp", 300, 0.15)]


def test_high_error_rate_at_the_rules_own_values(spark):
    rows = [("svc", _at(i), "500" if i % 10 == 0 else "200") for i in range(60)]
    requests = spark.createDataFrame(rows, "job string, ts timestamp_ntz, status_code string")
    table = ar.alert_table([ar.high_error_rate(requests, ["job"])])
    rows = table.orderBy("eval_ts").collect()
    assert [r.state for r in rows[:6]] == [P, P, P, P, F_, F_]
    assert rows[0].summary == "High error rate on svc"
    assert rows[0].description == "Server errors are 100% of the requests to svc."
    assert rows[15].description == "Server errors are 10% of the requests to svc."


def test_rules_name_the_labels_that_the_series_has(spark):
    samples = spark.createDataFrame(
        [("shop", "web-1", _at(i), 0.0) for i in range(3)],
        "namespace string, pod string, ts timestamp_ntz, value double")
    row = ar.pod_not_ready(samples, ["namespace", "pod"]).first()
    assert (row.summary, row.description) == (
        "shop/web-1 is not ready", "web-1 has not been ready for some time.")
    assert ar.pod_not_ready(samples, ["pod"]).first().summary == "/web-1 is not ready"


def test_undefined_value_is_no_breach(spark):
    series = spark.createDataFrame([("a", T0, None)], "job string, window_end timestamp_ntz, v double")
    row = ar.evaluations(ar.HIGH_LATENCY, series, ["job"], "v").first()
    assert row.breach is False


def test_nan_never_reaches_a_threshold(spark):
    requests = spark.createDataFrame([], "job string, ts timestamp_ntz, duration_seconds double")
    assert ar.high_latency(requests, ["job"]).count() == 0


def test_service_down_reads_the_latest_sample(spark):
    samples = spark.createDataFrame(
        [("x-1", _at(0), 0.0), ("x-1", _at(1), 1.0), ("y", _at(0), 0.0)],
        "job string, ts timestamp_ntz, value double")
    found = ar.service_down(samples, ["job"], job="x-.*").orderBy("eval_ts").collect()
    assert {r.labels for r in found} == {'{"job":"x-1"}'}
    assert [r.breach for r in found][:2] == [True, False]


def test_rules_are_held_apart_and_stored(spark, tmp_path):
    samples = spark.createDataFrame(
        [("a", _at(i), 0.0) for i in range(20)], "job string, ts timestamp_ntz, value double")
    table = ar.alert_table([ar.service_down(samples, ["job"]), ar.pod_not_ready(samples, ["job"])])
    for _ in range(2):  # a repeated run replaces what it stored
        append_alerts(table, str(tmp_path / "alerts"), "1")
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == table.count()
    stored = spark.read.parquet(str(tmp_path / "alerts"))
    first = {
        r.alert: r.at for r in stored.where("state = 'firing'").groupBy("alert").agg(F.min("eval_ts").alias("at")).collect()}
    assert first == {"ServiceDown": _at(3), "PodNotReady": _at(11)}
