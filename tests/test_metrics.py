"""Counters, histograms, ratios and gauges, against brute force in Python."""

import random
from datetime import datetime, timedelta

import pytest

from opsledger.operators import counters, gauges, histograms, ratios
from opsledger.sinks.exposition import counter_lines, histogram_lines
from opsledger.sources.samples import malformed_samples, parse_samples, read_scrapes

T0 = datetime(2024, 1, 1)
COUNTER = "s string, ts timestamp_ntz, value double"


def _at(seconds):
    return T0 + timedelta(seconds=seconds)


def _random_counter(seed):
    rng, rows = random.Random(seed), []
    for series in "ab":
        value = 0
        for i in range(300):
            if rng.random() < 0.1:
                continue
            value = 0 if rng.random() < 0.1 else value + rng.randint(0, 5)
            rows.append((series, _at(30 * i), float(value)))
    return rows


@pytest.mark.parametrize("chunk_s", [30, 60, 3600, 86400])
def test_deltas_do_not_depend_on_chunks(spark, chunk_s):
    rows = _random_counter(1)
    expected, last = {}, {}
    for s, at, value in rows:
        if s not in last:
            expected[s, at] = None
        else:
            expected[s, at] = value if value < last[s] else value - last[s]
        last[s] = value
    found = counters.counter_deltas(spark.createDataFrame(rows, COUNTER), ["s"], chunk_s=chunk_s)
    assert {(r.s, r.ts): r.delta for r in found.collect()} == expected


@pytest.mark.parametrize("chunk_s", [60, 86400])
@pytest.mark.parametrize("range_s, step_s", [(300, 30), (300, 300), (900, 60)])
def test_increase_against_brute_force(spark, range_s, step_s, chunk_s):
    rows = _random_counter(2)
    expected = {}
    for s in "ab":
        mine = [(at, v) for k, at, v in rows if k == s]
        for k in range(-range_s // step_s, 9000 // step_s + 1):
            start, end = _at(step_s * k), _at(step_s * k + range_s)
            inside = [v for at, v in mine if start <= at < end]
            if len(inside) >= 2:
                expected[s, end] = sum(
                    b if b < a else b - a for a, b in zip(inside, inside[1:]))
    found = counters.counter_increase(
        spark.createDataFrame(rows, COUNTER), ["s"], range_s, step_s, chunk_s=chunk_s)
    assert {(r.s, r.window_end): r.increase for r in found.collect()} == expected


def test_single_sample_has_no_increase(spark):
    rows = [("a", _at(0), 5.0)]
    assert counters.counter_increase(spark.createDataFrame(rows, COUNTER), ["s"]).count() == 0


def test_range_must_be_a_multiple_of_the_step(spark):
    with pytest.raises(ValueError):
        counters.counter_increase(spark.createDataFrame([], COUNTER), ["s"], 300, 70)


def test_event_rate(spark):
    frame = spark.createDataFrame([("a", _at(i)) for i in range(60)], "s string, ts timestamp_ntz")
    rates = {r.window_end: r.rate for r in counters.event_rate(frame, ["s"], "ts", 60, 30).collect()}
    assert rates == {_at(30): 0.5, _at(60): 1.0, _at(90): 0.5}


def test_cardinality(spark):
    frame = spark.createDataFrame(
        [("m", "a", "1"), ("m", "a", "1"), ("m", "b", None), ("n", "a", "1")], "metric string, x string, y string")
    found = counters.series_cardinality(frame, "metric", ["x", "y"])
    assert {r.metric: r.n_series for r in found.collect()} == {"m": 2, "n": 1}


def test_histogram_bounds_are_inclusive(spark):
    frame = spark.createDataFrame(
        [("k", 0.005), ("k", 0.3), ("k", 10.0), ("k", 11.0), ("k", None)], "k string, v double")
    rows = histograms.latency_histogram(frame, ["k"], "v").orderBy("le").collect()
    assert [r.cum_count for r in rows] == [1, 1, 1, 1, 1, 1, 2, 2, 2, 2, 3, 4]
    assert rows[-1].le == float("inf")
    assert rows[0].observations == 4 and abs(rows[0].observed_sum - 21.305) < 1e-9


def _quantile(spark, counts, q, bounds=(1.0, 2.0, 4.0, float("inf"))):
    frame = spark.createDataFrame([("k", b, c) for b, c in zip(bounds, counts)], "k string, le double, cum_count long")
    return histograms.histogram_quantile(frame, ["k"], q).first()["quantile"]


@pytest.mark.parametrize(
    "counts, q, expected",
    [
        ((0, 0, 0, 0), 0.95, None),
        ((10, 10, 10, 10), 0.5, 0.5),
        ((0, 10, 10, 10), 0.5, 1.5),
        ((0, 0, 0, 10), 0.5, 4.0),
        ((5, 5, 10, 10), 0.75, 3.0),
        ((5, 5, 10, 10), 0.5, 1.0),
        ((5, 4, 10, 10), 1.0, 4.0),
    ],
)
def test_histogram_quantile(spark, counts, q, expected):
    assert _quantile(spark, counts, q) == expected


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_both_forms_of_the_quantile_agree(spark, q):
    rng = random.Random(4)
    rows = [(k, _at(i), rng.choice([0.001, 0.3, 2.5, 10.0, 50.0, rng.lognormvariate(0, 2)]))
            for k in "ab" for i in range(0, 2000, 7)] + [("none", _at(0), None)]
    frame = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    long = histograms.histogram_quantile(
        histograms.windowed_histogram(frame, ["k"], "v", "ts", 300, 30), ["k", "window_start", "window_end"], q)
    wide = histograms.latency_quantile(frame, ["k"], "v", q, "ts", 300, 30)
    assert sorted(map(str, long.collect())) == sorted(map(str, wide.collect()))


def test_histogram_without_unbounded_bucket_has_no_quantile(spark):
    assert _quantile(spark, (5, 10), 0.5, (1.0, 2.0)) is None
    with pytest.raises(ValueError):
        _quantile(spark, (5, 10), 1.5, (1.0, 2.0))


def test_error_ratio_needs_a_whole_match(spark):
    frame = spark.createDataFrame(
        [("j", c, _at(0)) for c in ("500", "503", "5000", "150", "200")],
        "job string, status_code string, ts timestamp_ntz")
    row = ratios.error_ratio(frame, ["job"], "ts", 300, 300).first()
    assert (row.n_part, row.n_all, row.ratio) == (2, 5, 0.4)


def test_undefined_ratio_is_null(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", 1.0)], "k string, value double")
    right = spark.createDataFrame([("a", 2.0), ("b", 0.0)], "k string, value double")
    found = {r.k: r.ratio for r in ratios.series_ratio(left, right, ["k"]).collect()}
    assert found == {"a": 0.5, "b": None}
    assert [r.k for r in ratios.series_and(left, right, ["k"]).orderBy("k").collect()] == ["a", "b"]


def test_stalled_publishing(spark):
    frame = spark.createDataFrame(
        [("a", "created", _at(0)), ("b", "created", _at(0)), ("b", "published", _at(1)), ("c", "published", _at(1))],
        "job string, kind string, ts timestamp_ntz")
    assert [r.job for r in ratios.publishing_stalled(frame, ["job"], "ts", 300, 300).collect()] == ["a"]


def test_latest_sample_expires(spark):
    frame = spark.createDataFrame([("a", _at(0), 1.0), ("a", _at(40), 0.0)], COUNTER)
    found = {r.window_end: r.value for r in gauges.latest_sample(frame, ["s"], 60, 30).collect()}
    assert found == {_at(30): 1.0, _at(60): 0.0, _at(90): 0.0}


def test_gauge_ratio(spark):
    frame = spark.createDataFrame(
        [("a", "free", _at(0), 1.0), ("a", "size", _at(1), 4.0), ("b", "free", _at(0), 1.0),
         ("c", "free", _at(0), 1.0), ("c", "size", _at(0), 0.0)],
        "s string, metric string, ts timestamp_ntz, value double")
    found = gauges.gauge_ratio(frame, ["s"], "free", "size", 60, 60)
    assert {r.s: r.ratio for r in found.collect()} == {"a": 0.25, "c": None}


def test_utilisation(spark):
    frame = spark.createDataFrame(
        [("a", "p", _at(0), 75.0, 100.0), ("a", "q", _at(0), 70.0, 100.0), ("a", "q", _at(1), 90.0, 100.0),
         ("b", "p", _at(0), 10.0, 0.0)],
        "s string, pod string, ts timestamp_ntz, value double, requested double")
    rows = {r.s: (r.utilisation_pct, r.above_target) for r in gauges.utilisation(frame, ["s"], 60, 60).collect()}
    assert rows == {"a": (77.5, True), "b": (None, None)}


def test_sample_text(spark):
    lines = [
        "# HELP requests_total Total number of requests",
        "",
        'requests_total{method="POST", path="/a,b", status_code="201"} 142',
        'requests_total{q="say \\"hi\\"\\n"} 1.5e3 1700000000000',
        "up 1",
        "odd NaN",
        "big +Inf",
    ]
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    rows = parse_samples(frame).collect()
    assert [r.metric for r in rows] == ["requests_total", "requests_total", "up", "odd", "big"]
    assert rows[0].labels == {"method": "POST", "path": "/a,b", "status_code": "201"}
    assert rows[1].labels == {"q": 'say "hi"\n'}
    assert [rows[i].value for i in (0, 1, 2)] == [142.0, 1500.0, 1.0]
    assert rows[3].value != rows[3].value and rows[4].value == float("inf")
    assert rows[2].labels == {}


def test_bad_sample_lines_go_to_the_side(spark):
    lines = ['a{x="1",x="2"} 1', "a{x=1} 1", "a one", 'a{x="1" 2', "a 1 1700000000000", "# c", "  ", "b 2"]
    frame = spark.createDataFrame([(T0, line) for line in lines], "ts timestamp, line string")
    good = parse_samples(frame).collect()
    assert [(r.metric, r.value) for r in good] == [("a", 1.0), ("b", 2.0)]
    assert [r.ts for r in good] == [datetime(2023, 11, 14, 22, 13, 20), T0]
    assert [r.line for r in malformed_samples(frame).collect()] == lines[:4]


def test_growth_after_a_restart_is_kept_beside_large_values(spark):
    rows = [("a", _at(30 * i), v) for i, v in enumerate([0.0, 1e17, 0.5, 1.5])]
    found = counters.counter_increase(spark.createDataFrame(rows, COUNTER), ["s"], 90, 30).collect()
    by_end = {r.window_end: r.increase for r in found}
    assert by_end[_at(120)] == 1.5 and by_end[_at(150)] == 1.0


def test_text_form_reads_back(spark, tmp_path):
    rows = [('a,"b"\\n\n}', "x", 3.0), ("", None, 2.5)]
    counts = spark.createDataFrame(rows, "p string, q string, n double")
    lines = counter_lines(counts, "m_total", ["p", "q"])
    lines.write.text(str(tmp_path / "scrape"))
    found = parse_samples(read_scrapes(spark, str(tmp_path / "scrape")))
    assert {(r.labels["p"], r.labels["q"]): r.value for r in found.collect()} == {
        (rows[0][0], "x"): 3.0, ("", ""): 2.5}
    assert found.where("ts IS NULL").count() == 0


def test_text_form_of_a_histogram(spark):
    frame = spark.createDataFrame([("k", 0.3), ("k", 11.0)], "k string, v double")
    lines = {r.line for r in histogram_lines(histograms.latency_histogram(frame, ["k"], "v"), "d", ["k"]).collect()}
    assert len(lines) == 14
    assert {'d_bucket{k="k",le="0.5"} 1', 'd_bucket{k="k",le="+Inf"} 2', 'd_bucket{k="k",le="10"} 1',
            'd_sum{k="k"} 11.3', 'd_count{k="k"} 2'} <= lines


def test_sample_lines_that_hold_the_mark(spark):
    from opsledger.sources.samples import malformed_samples, parse_samples

    lines = ['m{a="x\x01y",b="\x01"} 4', "m 5 7\x018", "m\x01 5", "a\x01b\x01c\x01d", "m{} 1", 'm{a="1"', None, "# x", ""]
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    found = sorted((r.metric, sorted(r.labels.items()), r.value) for r in parse_samples(frame).collect())
    assert found == [("m", [], 1.0), ("m", [("a", "x\x01y"), ("b", "\x01")], 4.0)]
    assert sorted(r.line for r in malformed_samples(frame).collect()) == sorted(lines[1:4] + [lines[5]])
