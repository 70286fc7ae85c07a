"""One key with more than a third of all rows: results stay whole on every path."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsledger.functions.joins import lookup_join
from opsledger.operators import counters, events as ev, gauges, histograms, logs as lg, ratios
from opsledger.operators import orders as od
from opsledger.operators.quantiles import exact_quantile

N = 20_000
T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """Half of the rows belong to one key; times go through six hours."""
    hot = F.col("id") % 2 == 0
    return spark.range(0, N, numPartitions=8).select(
        "id",
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"),
        (F.lit(T0.isoformat()).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 1.08)).alias("ts"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 1000).alias("v"),
    ).persist()


@pytest.fixture(scope="module")
def local(rows):
    return [tuple(r) for r in rows.collect()]


@pytest.mark.parametrize("max_rows", [0, 10_000])
def test_lookup_keeps_every_row(rows, max_rows):
    names = rows.select("k").distinct().withColumn("name", F.upper("k"))
    joined = lookup_join(rows, names, ["k"], max_rows=max_rows)
    assert joined.count() == N
    assert joined.where("name <> upper(k)").count() == 0


def test_routing_by_salted_rules(spark, rows):
    rules = spark.createDataFrame(
        [("hot", [("a", "t", 1, None), ("b", "u", 2, None)])],
        "event_type string, channels array<struct<type:string,template:string,retry:int,level:string>>")
    default = F.array(F.struct(
        F.lit("log").alias("type"), F.lit(None).cast("string").alias("template"),
        F.lit(None).cast("int").alias("retry"), F.lit("warning").alias("level")))
    events = rows.select("id", F.col("k").alias("event_type"))
    salted = ev.route_events(events, rules, default, is_small=False)
    assert {r.channel: r["count"] for r in salted.groupBy("channel").count().collect()} == {
        "a": N // 2, "b": N // 2, "log": N // 2}


def test_exact_quantile_of_a_hot_group(rows):
    expected = {r.k: r.q for r in rows.groupBy("k").agg(F.percentile("v", 0.95).alias("q")).collect()}
    found = exact_quantile(rows, ["k"], "v", 0.95, small_group=1000)
    values = {r.k: r["quantile"] for r in found.collect()}
    assert values.keys() == expected.keys()
    assert all(abs(values[k] - expected[k]) < 1e-9 for k in values)


def test_windowed_histogram_and_ratio(rows, local):
    counts = {}
    for _, k, ts, v in local:
        first = T0 + timedelta(seconds=(ts - T0).total_seconds() // 600 * 600)
        for i in range(6):
            cell = counts.setdefault((k, first + timedelta(seconds=600 * (i + 1))), [0, 0])
            cell[0] += v <= 10.0
            cell[1] += 1
    found = histograms.windowed_histogram(rows, ["k"], "v", "ts", 3600, 600)
    wide = found.where("le IN (10.0, double('inf'))").groupBy("k", "window_end").agg(
        F.min("cum_count").alias("low"), F.max("cum_count").alias("all"))
    assert {(r.k, r.window_end): [r.low, r["all"]] for r in wide.collect()} == counts
    ratio = ratios.windowed_ratio(rows, ["k"], F.col("v") <= 10.0, "ts", 3600, 600)
    assert {(r.k, r.window_end): [r.n_part, r.n_all] for r in ratio.collect()} == counts


def test_counter_of_a_hot_series(rows, local):
    samples = rows.withColumn("v", F.floor("v").cast("double"))
    expected, last = {}, {}
    for i, k, ts, v in sorted(local):
        v = float(int(v))
        expected[k, ts] = None if k not in last else v if v < last[k] else v - last[k]
        last[k] = v
    found = counters.counter_deltas(samples, ["k"], "ts", "v", chunk_s=600)
    assert {(r.k, r.ts): r.delta for r in found.collect()} == expected


def test_latest_of_a_hot_series(rows, local):
    latest = {}
    for _, k, ts, v in sorted(local):
        latest[k, T0 + timedelta(seconds=((ts - T0).total_seconds() // 600 + 1) * 600)] = v
    found = gauges.latest_sample(rows, ["k"], 600, 600, "ts", "v")
    assert {(r.k, r.window_end): r.value for r in found.collect()} == latest


def test_repeated_ids_collapse(rows):
    orders = rows.select(F.col("k").alias("id"))
    events = rows.where("k <> 'hot'").select(F.col("k").alias("order_id"))
    (row,) = ev.reconcile(orders, events).collect()
    assert tuple(row) == ("hot", "order without event", N // 2, 0)
    copies = rows.select(F.col("k").alias("event_id"), F.lit("same").alias("body"))
    assert ev.first_deliveries(copies).count() == rows.select("k").distinct().count()


def test_lookup_with_a_hot_request_key(spark, rows):
    orders = spark.createDataFrame(
        [("hot", "c", "p", 1, "pending", T0)],
        "id string, customer_id string, product_id string, quantity int, status string, created_at timestamp_ntz")
    found = od.lookup_orders(rows.select(F.col("k").alias("id")), orders)
    assert found.where("found").count() == 1
    assert found.count() == rows.select("k").distinct().count()


@pytest.mark.parametrize("max_rows", [0, 10_000])
def test_log_lines_of_a_hot_app(spark, rows, local, max_rows):
    start, end = T0 + timedelta(hours=1), T0 + timedelta(hours=3, minutes=10)
    spans = spark.createDataFrame([("hot", start, end)], "k string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    found = lg.logs_during(rows, spans, ["k"], max_rows=max_rows)
    assert found.count() == sum(k == "hot" and start <= ts <= end for _, k, ts, _ in local)
