import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsledger.functions import text
from opsledger.functions.timegrid import in_last
from opsledger.operators import logs as lg
from opsledger.operators.quantiles import exact_quantile
from opsledger.sources import logs as source

T0 = datetime(2024, 1, 1)


def _at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_path_keys(spark):
    frame = spark.createDataFrame(
        [("/var/log/pods/ns_pod-1_ab-12/app/0.log",), ("file:///var/log/pods/7/side/12.log",), ("/tmp/x.log",)],
        "path string")
    rows = source.with_file_keys(frame).collect()
    assert [(r.uid, r.container) for r in rows] == [("ab-12", "app"), ("7", "side"), ("", "")]


def test_log_files(spark, tmp_path):
    folder = tmp_path / "u1" / "app"
    folder.mkdir(parents=True)
    (folder / "0.log").write_text("one\ntwo\n")
    rows = source.read_log_files(spark, f"{tmp_path}/*/*/*.log").collect()
    assert [r.line for r in rows] == ["one", "two"] and rows[0].path.endswith("/u1/app/0.log")


def test_stopped_pods_drop_out(spark):
    phases = ["Running", "Pending", "Succeeded", "Failed", "Completed", "FailedX", None]
    pods = spark.createDataFrame(
        [(str(i), "n", "p", "c", "a", ph) for i, ph in enumerate(phases)],
        "uid string, namespace string, pod string, container string, app string, phase string")
    targets = source.pod_targets(pods).collect()
    assert [r.uid for r in targets] == ["0", "5", "6"]
    assert targets[0].path_glob == "/var/log/pods/*0*/*c*/*.log"


def test_matchers(spark):
    frame = spark.createDataFrame(
        [("dev", "order", "a timeout b"), ("dev-2", "order", "fine"), ("dev", "orders", "TIMEOUT")],
        "namespace string, app string, line string")
    assert frame.where(lg.label_matches(namespace="dev")).count() == 2
    assert frame.where(lg.label_matches(namespace="dev.*", app="order")).count() == 2
    assert frame.where(lg.label_is(namespace="dev", app="order")).count() == 1
    assert frame.where(lg.line_matches("timeout|refused")).count() == 1
    assert frame.where(lg.line_contains("TIMEOUT")).count() == 1
    assert frame.where(~lg.line_contains("fine")).count() == 2


def test_json_filters(spark):
    lines = ['{"level":"ERROR","status_code":500}', '{"level":"error","status_code":"503"}',
             '{"level":"ERROR","status_code":"n/a"}', "not json", '{"level":"ERROR"}']
    frame = source.parse_log_json(spark.createDataFrame([(x,) for x in lines], "line string"))
    assert frame.where(lg.json_equals("level", "ERROR")).count() == 3
    assert frame.where(lg.json_equals("level", "error", ignore_case=True)).count() == 4
    assert frame.where(lg.json_at_least("status_code", 500)).count() == 2


def test_trace_id(spark):
    frame = spark.createDataFrame([('{"trace_id":"ab1","x":1}',), ('{"x":1}',)], "line string")
    assert [r[0] for r in frame.select(text.trace_id("line")).collect()] == ["ab1", None]


def test_log_line_is_escaped_json(spark):
    frame = spark.createDataFrame([(T0, 'say "hi"')], "t timestamp_ntz, m string")
    line = frame.select(
        text.log_line(F.col("t"), F.lit("INFO"), F.lit("n"), F.col("m"), order_id=F.lit(None).cast("string")))
    assert line.first()[0] == (
        '{"time":"2024-01-01 00:00:00,000","level":"INFO","name":"n","message":"say \\"hi\\""}')


def test_last_hour(spark):
    frame = spark.createDataFrame([(_at(s),) for s in (0, 3599, 3600, 7199, 7200)], "ts timestamp_ntz")
    assert in_last(frame, "ts", 3600, _at(7200)).count() == 2


@pytest.mark.parametrize("small_group", [10_000, 100, 0])
@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_exact_quantile(spark, q, small_group):
    rng = random.Random(3)
    rows = [("wide", rng.lognormvariate(0, 3)) for _ in range(2000)]
    rows += [("same", 7.0)] * 500 + [("two", 1.0), ("two", 3.0), ("one", 4.0), ("none", None)]
    rows += [("ties", float(rng.randint(0, 3))) for _ in range(500)]
    frame = spark.createDataFrame(rows, "k string, v double")
    expected = {
        r.k: r.q for r in frame.groupBy("k").agg(F.percentile("v", q).alias("q")).collect() if r.q is not None}
    found = {r.k: r["quantile"] for r in exact_quantile(frame, ["k"], "v", q, small_group).collect()}
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) <= 1e-9 * max(1, abs(expected[k])) for k in found)


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_lines_during_an_alert(spark, max_rows):
    lines = spark.createDataFrame(
        [("a" if i % 2 else "b", _at(60 * i)) for i in range(600)], "app string, ts timestamp_ntz")
    spans = [("a", _at(1200), _at(20000)), ("b", _at(3600), _at(3600)), ("a", _at(10000), _at(11000)), ("c", _at(0), _at(9))]
    intervals = spark.createDataFrame(spans, "app string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    found = lg.logs_during(lines, intervals, ["app"], max_rows=max_rows)
    expected = sorted(
        (r.app, r.ts, start) for r in lines.collect() for app, start, end in spans
        if app == r.app and start <= r.ts <= end)
    assert sorted((r.app, r.ts, r.start_ts) for r in found.collect()) == expected


def test_a_long_alert_is_a_few_blocks(spark):
    rng = random.Random(2)
    spans = [(0, 365 * 86400), (5, 5), (3600, 3599), (-7200, 86400)]
    spans += [(a, a + rng.randrange(10**6)) for a in (rng.randrange(-(10**6), 10**6) for _ in range(60))]
    base = datetime(1970, 1, 1)
    rows = [(i, base + timedelta(seconds=a), base + timedelta(seconds=b)) for i, (a, b) in enumerate(spans)]
    frame = spark.createDataFrame(rows, "i int, start_ts timestamp_ntz, end_ts timestamp_ntz")
    blocks = {}
    for r in lg.interval_blocks(frame, 3600).collect():
        blocks.setdefault(r.i, []).extend(range(r["__block"] << r["__size"], (r["__block"] + 1) << r["__size"]))
    assert lg.interval_blocks(frame.where("i = 0"), 3600).count() < 40
    for i, (a, b) in enumerate(spans):
        assert sorted(blocks.get(i, [])) == (list(range(a // 3600, b // 3600 + 1)) if a <= b else [])


def test_tail_by_threshold(spark):
    rng = random.Random(5)
    rows = [(_at(rng.choice([0, 1, 59, 3600, 3601, 86400, 90061])) if rng.random() < 0.95 else None, f"l{i}") for i in range(900)]
    frame = spark.createDataFrame(rows, "ts timestamp_ntz, line string").repartition(7)
    ordered = sorted(rows, key=lambda r: (-(r[0] - _at(0)).total_seconds() if r[0] else 10**9, r[1]))
    for limit in (1, 130, 500, 899, 5000):
        found = lg.tail(frame, [F.col("ts").desc(), F.col("line")], limit, newest_by="ts")
        assert [(r.ts, r.line) for r in found.collect()] == ordered[:limit]
    assert lg.tail(frame.limit(0), [F.col("ts").desc()], 5, newest_by="ts").count() == 0


def test_tail_keeps_the_newest_of_many_partitions(spark):
    frame = spark.range(0, 5000, numPartitions=20).select(
        (F.col("id") * 7919 % 5000).alias("ts"), F.col("id").cast("string").alias("line"))
    found = lg.tail(frame, [F.col("ts").desc()], 1000)
    assert [r.ts for r in found.collect()] == list(range(4999, 3999, -1))
    assert [r.ts for r in lg.tail(frame, [F.col("ts").desc()], 1500).collect()] == list(range(4999, 3499, -1))


def test_approximate_quantile_is_an_option(spark):
    frame = spark.createDataFrame(
        [("a", _at(i), '{"d":%d}' % i) for i in range(100)], "app string, ts timestamp_ntz, line string")
    exact = lg.field_quantile(frame, ["app"], "d", 0.95, 300, 300).first()
    near = lg.field_quantile(frame, ["app"], "d", 0.95, 300, 300, approximate=True).first()
    assert exact["quantile"] == 94.05 and near["quantile"] == 94.0
