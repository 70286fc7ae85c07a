"""Randomised checks against plain Python."""

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsledger.operators import alerts, counters
from opsledger.operators import orders as od
from opsledger.operators.quantiles import exact_quantile

hypothesis = pytest.importorskip("hypothesis")
from hypothesis import HealthCheck, given, settings, strategies as st  # noqa: E402

T0 = datetime(2024, 1, 1)
FEW = settings(
    max_examples=8, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def _at(seconds):
    return T0 + timedelta(seconds=seconds)


@FEW
@given(
    st.dictionaries(st.integers(0, 400), st.integers(0, 9), max_size=60),
    st.sampled_from([(60, 60), (60, 20), (300, 60)]),
    st.sampled_from([20, 60, 3600]),
)
def test_increase(spark, samples, grid, chunk_s):
    range_s, step_s = grid
    rows = [("s", _at(at), float(value)) for at, value in samples.items()]
    frame = spark.createDataFrame(rows, "s string, ts timestamp_ntz, value double")
    expected = {}
    for end in range(step_s, 400 + range_s + step_s, step_s):
        inside = [float(v) for at, v in sorted(samples.items()) if end - range_s <= at < end]
        if len(inside) >= 2:
            expected[_at(end)] = sum(b if b < a else b - a for a, b in zip(inside, inside[1:]))
    found = counters.counter_increase(frame, ["s"], range_s, step_s, chunk_s=chunk_s)
    assert {r.window_end: r.increase for r in found.collect()} == expected


@FEW
@given(
    st.dictionaries(st.integers(0, 60), st.booleans(), max_size=50),
    st.integers(0, 5),
    st.sampled_from([30, 120, 86400]),
)
def test_states(spark, evaluations, hold, chunk_s):
    rows = [("s", _at(30 * at), breach) for at, breach in evaluations.items()]
    frame = spark.createDataFrame(rows, "s string, eval_ts timestamp_ntz, breach boolean")
    expected, since, last = {}, None, None
    for at, breach in sorted(evaluations.items()):
        since = None if not breach else at if since is None or last != at - 1 else since
        last = at
        expected[_at(30 * at)] = (
            "inactive" if since is None else "firing" if at - since >= hold else "pending")
    found = alerts.alert_states(frame, ["s"], 30, 30 * hold, chunk_s=chunk_s)
    assert {r.eval_ts: r.state for r in found.collect()} == expected


@FEW
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e6, 1e6)), min_size=1, max_size=80),
    st.sampled_from([0.0, 0.25, 0.95, 1.0]),
    st.sampled_from([0, 10, 100_000]),
)
def test_quantile(spark, rows, q, small_group):
    groups = defaultdict(list)
    for key, value in rows:
        groups[key].append(value)
    found = exact_quantile(
        spark.createDataFrame(rows, "k string, v double"), ["k"], "v", q, small_group)
    values = {r.k: r["quantile"] for r in found.collect()}
    assert values.keys() == groups.keys()
    for key, group in groups.items():
        ordered = sorted(group)
        low = int(q * (len(group) - 1))
        high = min(low + 1, len(group) - 1)
        expected = ordered[low] + (ordered[high] - ordered[low]) * (q * (len(group) - 1) - low)
        assert values[key] == pytest.approx(expected, rel=1e-9, abs=1e-6)


@FEW
@given(
    st.lists(st.tuples(st.integers(0, 20 * 86400), st.sampled_from(["pending", "confirmed", "other"])), max_size=60),
    st.sampled_from([(7, 86400, 21600), (1, 1800, 0), (7, 7 * 86400, 4 * 86400 + 21600)]),
)
def test_sliding_reports(spark, orders, schedule):
    days, every, anchor = schedule
    frame = spark.createDataFrame([(s, _at(at)) for at, s in orders], "status string, created_at timestamp_ntz")
    epoch = datetime(1970, 1, 1)
    runs = defaultdict(lambda: [0, 0, 0])
    for at, status in orders:
        moment = _at(at)
        passed = int((moment - epoch).total_seconds()) - anchor
        run = epoch + timedelta(seconds=anchor + (passed // every + 1) * every)
        while run - timedelta(days=days) <= moment:
            for i, counted in enumerate((True, status == "pending", status == "confirmed")):
                runs[run][i] += counted
            run += timedelta(seconds=every)
    run = min(runs, default=None)
    while runs and run < max(runs):
        runs[run]  # runs over empty periods are listed too
        run += timedelta(seconds=every)
    found = od.sliding_summary(frame, days * 86400, every, anchor)
    assert {r.period_end: [r.total_orders, r.pending, r.confirmed] for r in found.collect()} == dict(runs)
    assert found.where(F.expr(f"period_start + INTERVAL {days} DAYS <> period_end")).count() == 0
