import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsledger.operators import alerts
from opsledger.operators import logs as lg
from opsledger.plans import views as v
from opsledger.sinks.tables import publish_event_stream
from opsledger.sources.logs import pod_targets, stream_log_files, with_file_keys
from opsledger.sources.messages import stream_messages
from opsledger.sources.rules import NOTIFICATION_RULES, default_channels, rules_table
from opsledger.streaming import pipelines
from opsledger.streaming.parts import Parts

T0 = datetime(2024, 1, 1)


def _write(folder, name, bodies):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(bodies) + "\n")


def _route(spark, folder, max_files=None):
    query = pipelines.route_messages(
        stream_messages(spark, str(folder / "in"), max_files),
        rules_table(spark, NOTIFICATION_RULES),
        default_channels(NOTIFICATION_RULES),
        str(folder / "sent"),
        str(folder / "dead"),
        str(folder / "checkpoint"),
    )
    query.awaitTermination()
    sent = spark.read.parquet(str(folder / "sent"))
    dead = spark.read.parquet(str(folder / "dead"))
    return sorted((r.event_type, r.channel) for r in sent.collect()), sorted(r.body_head for r in dead.collect())


def test_routing_resumes_without_repeating(spark, tmp_path):
    created = json.dumps({"event_type": "order.created", "payload": {"order_id": "1"}})
    _write(tmp_path / "in", "1.txt", [created, "broken {"])
    first = [("order.created", "email"), ("order.created", "push")]
    assert _route(spark, tmp_path) == (first, ["broken {"])
    assert _route(spark, tmp_path) == (first, ["broken {"])
    _write(tmp_path / "in", "2.txt", ['{"event_type":"odd"}', "[1]"])
    assert _route(spark, tmp_path) == ([("odd", "log"), *first], ["[1]", "broken {"])


def test_failed_batch_is_replayed(spark, tmp_path, monkeypatch):
    _write(tmp_path / "in", "1.txt", ['{"event_type":"order.cancelled"}', "broken"])
    real = pipelines.write_batch

    def fail_on_dead(df, path, batch_id, run):
        if path.endswith("dead"):
            raise RuntimeError("sink down")
        real(df, path, batch_id, run)

    monkeypatch.setattr(pipelines, "write_batch", fail_on_dead)
    with pytest.raises(Exception, match="sink down"):
        _route(spark, tmp_path)
    monkeypatch.setattr(pipelines, "write_batch", real)
    assert _route(spark, tmp_path) == ([("order.cancelled", "email")], ["broken"])


def _events_stream(spark, folder, *batches):
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "event_id long, ts timestamp")
        frame.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema("event_id long, ts timestamp").parquet(str(folder))


def test_dedup_within_the_watermark(spark, tmp_path):
    events = _events_stream(
        spark, tmp_path / "in", [(1, T0), (2, T0), (1, T0)], [(2, T0 + timedelta(seconds=30)), (3, T0)])
    pipelines.append_stream(
        pipelines.dedup_stream(events), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_late_rows_and_open_windows_count(spark, tmp_path):
    schema = "ts timestamp, job string, status_code string"

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        requests = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        pipelines.error_ratio_stream(
            requests, ["job"], 300, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
        buckets = pipelines.stored_buckets(spark, str(tmp_path / "out"), str(tmp_path / "c"))
        out = pipelines.error_ratios(buckets, ["job"], 300, 300)
        return sorted((r.window_start, r.n_part, r.n_all) for r in out.collect())

    minute = timedelta(minutes=1)
    assert run([(T0, "a", "500"), (T0 + 30 * minute, "a", "200")]) == [
        (T0, 1, 1), (T0 + 30 * minute, 0, 1)]
    assert run([(T0 + minute, "a", "500"), (T0 + 60 * minute, "a", "200")]) == [
        (T0, 2, 2), (T0 + 30 * minute, 0, 1), (T0 + 60 * minute, 0, 1)]


def test_windows_close_once_and_corrections_make_them_whole(spark, tmp_path):
    schema = "ts timestamp_ntz, job string"
    minute, names = timedelta(minutes=1), ["n", "n_a"]
    counts = {"n": F.count("*"), "n_a": F.count_if(F.col("job") == "a")}
    batches = [[0, 1, 5, 12], [7, 20, 21], [3, 40], [2, 4, 30, 41, 90], [0, 91]]
    rows = [[(T0 + m * minute, j) for m in b for j in ("a", None)] for b in batches]
    folder = {n: str(tmp_path / n) for n in ("in", "windows", "buckets", "c1", "c2")}
    closed_before = set()
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder["in"])
        stream = spark.readStream.schema(schema).parquet(folder["in"])
        pipelines.window_stream(
            stream, ["job"], counts, 900, 300, folder["windows"], folder["c1"]).awaitTermination()
        pipelines.bucket_stream(stream, ["job"], counts, 300, folder["buckets"], folder["c2"]).awaitTermination()
        closed = spark.read.parquet(folder["windows"]).drop("batch_id")
        found = [(r.job, r.window_end) for r in closed.collect()]
        assert len(found) == len(set(found)) and closed_before <= set(found)
        closed_before = set(found)
        buckets = pipelines.stored_buckets(spark, folder["buckets"], folder["c2"])
        totals = pipelines.windows_of(buckets, ["job"], names, 900, 300)
        corrections = pipelines.window_corrections(closed, totals, ["job"], names)
        whole = pipelines.corrected_windows(closed, corrections, ["job"], names)
        assert pipelines.window_corrections(whole, totals, ["job"], names).count() == 0
    expected = {}
    for m in [m for b in batches for m in b]:
        for step in range(3):
            for job in ("a", None):
                key = job, T0 + (m // 5 * 5 + 5 + 5 * step) * minute
                n, n_a = expected.get(key, (0, 0))
                expected[key] = n + 1, n_a + (job == "a")
    assert {(r.job, r.window_end): (r.n, r.n_a) for r in whole.collect()} == expected
    late = [r for r in corrections.collect() if (r.job, r.window_end) in closed_before]
    assert late and len(closed_before) > 10
    some = pipelines.windows_of(buckets, ["job"], names, 900, 300, T0 + 10 * minute, T0 + 25 * minute)
    assert {(r.job, r.window_end): (r.n, r.n_a) for r in some.collect()} == {
        k: v for k, v in expected.items() if T0 + 10 * minute < k[1] <= T0 + 25 * minute}


def _part_table(spark, folder, stream="one", fan_in=3, merge=True):
    (folder / "c").mkdir(exist_ok=True)
    (folder / "c" / "metadata").write_text(json.dumps({"id": stream}))
    add_up = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n"))
    return Parts(spark, str(folder / "t"), str(folder / "c"), add_up if merge else None, fan_in)


def _total(table):
    return {r.k: r.n for r in table.read().groupBy("k").agg(F.sum("n").alias("n")).collect()}


def test_parts_grow_with_the_logarithm_and_ignore_replays(spark, tmp_path):
    table, first = _part_table(spark, tmp_path), None
    for i in range(30):
        table.add(spark.createDataFrame([("a", 1), (f"b{i % 2}", i)], "k string, n long"), i)
        table.add(spark.createDataFrame([("a", 1), (f"b{i % 2}", i)], "k string, n long"), i)
        live = table.live()
        assert [p["first"] for p in live] == [0, *[p["last"] + 1 for p in live[:-1]]] and live[-1]["last"] == i
        assert len(live) <= 2 * 4
        if i == 20:
            first = table.read()
    assert _total(table) == {"a": 30, "b0": sum(range(0, 30, 2)), "b1": sum(range(1, 30, 2))}
    table.add(spark.createDataFrame([("a", 1)], "k string, n long"), 4)
    assert _total(table)["a"] == 30
    # a reader of an earlier manifest goes on, for a while
    assert first.groupBy("k").agg(F.sum("n").alias("n")).where("k = 'a'").first()["n"] == 21
    files = {p.name for p in (tmp_path / "t").glob("run=*/parts/*")}
    assert len(files) < 30 + 10 - 15


def test_a_merge_that_fails_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    table = _part_table(spark, tmp_path)
    for i in range(2):
        table.add(spark.createDataFrame([("a", 1)], "k string, n long"), i)
    switch = Parts._switch

    def fails(self, manifest, parts, retired):
        if retired:
            raise RuntimeError("driver lost")
        return switch(self, manifest, parts, retired)

    monkeypatch.setattr(Parts, "_switch", fails)
    with pytest.raises(RuntimeError, match="driver lost"):
        table.add(spark.createDataFrame([("a", 1)], "k string, n long"), 2)
    assert _total(table) == {"a": 3} and len(table.live()) == 3
    monkeypatch.setattr(Parts, "_switch", switch)
    table.add(spark.createDataFrame([("a", 1)], "k string, n long"), 2)
    assert _total(table) == {"a": 3} and [p["level"] for p in table.live()] == [1]


def test_a_fresh_checkpoint_starts_the_table_anew(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "k string, n long")
    for i in range(4):
        _part_table(spark, tmp_path, "one", merge=False).add(rows, i)
    table = _part_table(spark, tmp_path, "two", merge=False)
    assert table.read().count() == 4
    table.add(rows, 0)
    assert table.read().count() == 1
    with pytest.raises(FileNotFoundError):
        Parts(spark, str(tmp_path / "none"), str(tmp_path / "c")).read()


def _stream_states(spark, folder, parts):
    schema = "job string, eval_ts timestamp, value double, breach boolean"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder / "in"))
        stream = spark.readStream.schema(schema).parquet(str(folder / "in"))
        pipelines.alert_state_stream(
            stream, ["job"], 30, 90, str(folder / "out"), str(folder / "c")).awaitTermination()
    states = pipelines.latest_states(spark, str(folder / "out"), ["job"], str(folder / "c"))
    found = {r.eval_ts: (r.active_since, r.state) for r in states.collect()}
    rows = [row for part in parts for row in part]
    batch = alerts.alert_states(spark.createDataFrame(rows, schema), ["job"], 30, 90)
    return found, {r.eval_ts: (r.active_since, r.state) for r in batch.collect()}


def test_streamed_alert_state_equals_batch_across_restarts(spark, tmp_path):
    breaches = [True] * 5 + [False] + [True] * 7 + [None, True, True] + [True] * 6
    rows = [("a", T0 + timedelta(seconds=30 * i), float(i), bool(b)) for i, b in enumerate(breaches) if b is not None]
    found, batch = _stream_states(spark, tmp_path, (rows[:4], rows[4:12], rows[12:]))
    assert found == batch


def test_streamed_alert_state_equals_batch_out_of_order(spark, tmp_path):
    rows = [("a", T0 + timedelta(seconds=30 * i), float(i), True) for i in range(6)]
    found, batch = _stream_states(spark, tmp_path, ([rows[0], rows[2]], [rows[1]], [rows[5], rows[3], rows[4]]))
    assert found == batch
    assert [s for _, (_, s) in sorted(found.items())] == ["pending"] * 3 + ["firing"] * 3


def _feed(spark, folder, rows, name):
    schema = "job string, eval_ts timestamp_ntz, value double, breach boolean"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / name))


def test_alert_state_does_not_grow_with_the_stream(spark, tmp_path):
    """Shuffled evaluations of two series over 14 micro-batches; one series ends early."""
    import random

    rng, rows = random.Random(1), []
    for i in range(140):
        for job in ("a", None) if i < 60 else ("a",):
            if rng.random() < 0.95:
                at = T0 + timedelta(seconds=30 * i)
                rows.append((job, at, float(i), rng.choice([True, True, True, False, None])))
    rows.sort(key=lambda r: r[1] + timedelta(seconds=rng.uniform(0, 240)))
    size = -(-len(rows) // 14)
    for part in range(14):
        _feed(spark, tmp_path, rows[part * size : (part + 1) * size], f"in/{part:02}")
    schema = "job string, eval_ts timestamp_ntz, value double, breach boolean"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    out, c = str(tmp_path / "out"), str(tmp_path / "c")
    query = pipelines.alert_state_stream(stream, ["job"], 30, 90, out, c, late_s=300)
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["numInputRows"]]
    assert len(kept) >= 14
    # ten open evaluations, a summary and timers for each of two series, however many have passed
    assert max(kept) < 45 and kept[-1] <= max(kept[3:6]) + 5
    states = pipelines.latest_states(spark, out, ["job"], c).collect()
    batch = alerts.alert_states(spark.createDataFrame(rows, schema), ["job"], 30, 90).collect()
    assert {(r.job, r.eval_ts): (r.active_since, r.state, r.value) for r in states} == {
        (r.job, r.eval_ts): (r.active_since, r.state, r.value) for r in batch}
    assert pipelines.late_evaluations(spark, out, c).count() == 0


def test_evaluations_behind_the_watermark_are_kept_and_corrected(spark, tmp_path):
    schema = "job string, eval_ts timestamp_ntz, value double, breach boolean"
    rows = [("a", T0 + timedelta(seconds=30 * i), float(i), True) for i in range(40)]
    out, c = str(tmp_path / "out"), str(tmp_path / "c")
    parts = [rows[:5] + rows[6:30], rows[30:], [rows[5], ("b", T0, 1.0, True), ("b", None, 1.0, True)]]
    for part in parts:
        _feed(spark, tmp_path, part, "in")
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        pipelines.alert_state_stream(stream, ["job"], 30, 90, out, c, late_s=120).awaitTermination()
    late = pipelines.late_evaluations(spark, out, c).collect()
    assert sorted((r.job, r.eval_ts or T0, r.value) for r in late) == [("a", rows[5][1], 5.0), ("b", T0, 1.0), ("b", T0, 1.0)]
    assert pipelines.latest_states(spark, out, ["job"], c).where("job = 'a'").count() == 39
    corrected = pipelines.correct_late(spark, out, ["job"], c, 30, 90).collect()
    batch = alerts.alert_states(spark.createDataFrame([*rows, ("b", T0, 1.0, True)], schema), ["job"], 30, 90).collect()
    assert {(r.job, r.eval_ts): (r.active_since, r.state) for r in corrected} == {
        (r.job, r.eval_ts): (r.active_since, r.state) for r in batch}


DELIVERIES = "event_id long, ts timestamp_ntz, retry int, needs int, labels map<string,string>"


def _deliver(spark, folder, send, seconds=60, wait=True):
    stream = spark.readStream.schema(DELIVERIES).parquet(str(folder / "in"))
    query = pipelines.delivery_stream(
        stream, send, str(folder / "sent"), str(folder / "dead"), str(folder / "c"), backoff_s=(0.1, 0.3), shards=2,
        trigger={"processingTime": "100 milliseconds"})
    if wait:
        pipelines.settle(query, seconds)
    return query


def _delivered(spark, folder, side):
    return sorted((r.event_id, r.attempts_made) for r in spark.read.parquet(str(folder / side)).collect())


def test_deliveries_are_tried_again_until_they_run_out(spark, tmp_path):
    odd = T0 + timedelta(microseconds=123456)
    rows = [(i, odd, [None, 0, 3][i % 3], i % 6, {"a": "1"}) for i in range(60)] + [(99, None, 2, 1, None)]
    _feed_deliveries(spark, tmp_path, rows)

    def send(frame):
        import json

        needs = [json.loads(b)["needs"] for b in frame["body"]]
        if any(n == 5 for n in needs) and frame["attempt"].max() == 1:
            raise OSError("sink down")
        return [n <= a for n, a in zip(needs, frame["attempt"])]

    _deliver(spark, tmp_path, send)
    sent, dead = (dict(_delivered(spark, tmp_path, side)) for side in ("sent", "dead"))
    assert sent.keys() | dead.keys() == {r[0] for r in rows} and not sent.keys() & dead.keys()
    for event_id, _, retry, needs, _ in rows:
        allowed = 1 + (retry or 0)
        # the first attempt of a shard failed whole, as its sink was down
        if event_id in dead:
            assert dead[event_id] == allowed and needs >= allowed or allowed == 1
        else:
            assert max(needs, 1) <= sent[event_id] <= allowed
    kept = {r.event_id: (r.ts, r.labels) for r in spark.read.parquet(str(tmp_path / "sent")).collect()}
    assert kept[99] == (None, None) and all(kept[i] == (odd, {"a": "1"}) for i in kept if i != 99)


def _feed_deliveries(spark, folder, rows):
    spark.createDataFrame(rows, DELIVERIES).coalesce(1).write.mode("append").parquet(str(folder / "in"))


def test_waiting_deliveries_survive_a_restart(spark, tmp_path):
    import time

    _feed_deliveries(spark, tmp_path, [(1, T0, 50, 1, None)])
    query = _deliver(spark, tmp_path, lambda frame: [False] * len(frame), wait=False)
    end = time.time() + 60
    while not (query.lastProgress and query.lastProgress["batchId"] >= 3) and time.time() < end:
        time.sleep(0.1)
    query.stop()
    assert _delivered(spark, tmp_path, "sent") == []
    _deliver(spark, tmp_path, lambda frame: [True] * len(frame))
    ((event_id, attempts),) = _delivered(spark, tmp_path, "sent")
    assert event_id == 1 and attempts >= 2 and _delivered(spark, tmp_path, "dead") == []


def test_a_large_shard_is_sent_and_kept_in_chunks(spark, tmp_path):
    n, big = 7000, str(tmp_path / "largest")
    needs = F.when(F.col("id") % 7 == 6, 9).otherwise(F.col("id") % 4 + 1)
    rows = spark.range(n).select(
        F.col("id").alias("event_id"), F.lit(T0).cast("timestamp_ntz").alias("ts"), F.lit(3).alias("retry"),
        needs.cast("int").alias("needs"), F.lit(None).cast("map<string,string>").alias("labels"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))

    def send(frame):
        import json

        with open(big, "a") as log:
            log.write(f"{len(frame)}\n")
        return [json.loads(b)["needs"] <= a for b, a in zip(frame["body"], frame["attempt"])]

    deliveries = spark.readStream.schema(DELIVERIES).parquet(str(tmp_path / "in"))
    pipelines.settle(pipelines.delivery_stream(
        deliveries, send, *(str(tmp_path / x) for x in ("sent", "dead", "c")), backoff_s=(0.1,), shards=1,
        trigger={"processingTime": "100 milliseconds"}), 120)
    wanted = {i: 9 if i % 7 == 6 else i % 4 + 1 for i in range(n)}
    assert _delivered(spark, tmp_path, "sent") == [(i, w) for i, w in wanted.items() if w < 9]
    assert _delivered(spark, tmp_path, "dead") == [(i, 4) for i, w in wanted.items() if w == 9]
    with open(big) as log:
        assert max(map(int, log)) <= 2000


def test_running_counts_end_at_the_totals(spark, sf, tmp_path):
    requests = v.fx_requests(v.stream_table(spark, sf, "events"))
    pipelines.running_counts(
        requests, ["method", "status_code"], str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    last = spark.read.parquet(str(tmp_path / "out")).groupBy("method", "status_code").agg(F.max("n").alias("n"))
    batch = v.fx_requests(v.table(spark, sf, "events")).groupBy("method", "status_code").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, batch.collect()))


def test_stored_orders_are_published_once(spark, tmp_path):
    schema = "event_type string, payload map<string,string>"
    spark.createDataFrame([("order.created", {"order_id": "1"})], schema).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        publish_event_stream(events, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    (row,) = spark.read.text(str(tmp_path / "out")).collect()
    assert json.loads(row.value) == {"event_type": "order.created", "payload": {"order_id": "1"}}
    assert row.routing_key == "order.created"


def test_stop_between_batches_and_go_on(spark, tmp_path):
    _write(tmp_path / "in", "1.txt", ['{"event_type":"a"}'])

    def start():
        return pipelines.route_messages(
            stream_messages(spark, str(tmp_path / "in")),
            rules_table(spark, NOTIFICATION_RULES),
            default_channels(NOTIFICATION_RULES),
            str(tmp_path / "sent"),
            str(tmp_path / "dead"),
            str(tmp_path / "checkpoint"),
            {"processingTime": "200 milliseconds"},
        )

    for name, body in (("2.txt", '{"event_type":"b"}'), ("3.txt", '{"event_type":"c"}')):
        query = start()
        query.processAllAvailable()
        _write(tmp_path / "in", name, [body])
        query.processAllAvailable()
        query.stop()
    sent = spark.read.parquet(str(tmp_path / "sent"))
    assert sorted(r.event_type for r in sent.collect()) == ["a", "b", "c"]


def test_flow_control_takes_one_file_per_batch(spark, tmp_path):
    for i in range(3):
        _write(tmp_path / "in", f"{i}.txt", [f'{{"event_type":"{i}"}}'])
    _route(spark, tmp_path, max_files=1)
    assert len(list((tmp_path / "sent").glob("run=*/batch_id=*"))) == 3


def test_a_new_checkpoint_does_not_replace_stored_batches(spark, tmp_path):
    _write(tmp_path / "in", "1.txt", ['{"event_type":"a"}'])
    _route(spark, tmp_path)
    (tmp_path / "checkpoint").rename(tmp_path / "old")
    pipelines.route_messages(
        stream_messages(spark, str(tmp_path / "in")),
        rules_table(spark, NOTIFICATION_RULES),
        default_channels(NOTIFICATION_RULES),
        str(tmp_path / "sent"),
        str(tmp_path / "dead"),
        str(tmp_path / "other"),
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "sent")).count() == 2


def test_notifications_out_of_attempts_are_set_aside(spark, tmp_path):
    bodies = [f'{{"event_type":"order.created","payload":{{"n":"{n}"}}}}' for n in (1, 3, 9)]
    _write(tmp_path / "in", "1.txt", bodies)
    pipelines.route_messages(
        stream_messages(spark, str(tmp_path / "in")),
        rules_table(spark, NOTIFICATION_RULES),
        default_channels(NOTIFICATION_RULES),
        str(tmp_path / "sent"),
        str(tmp_path / "dead"),
        str(tmp_path / "c"),
        attempts=F.try_element_at("payload", F.lit("n")).cast("int"),
        undelivered=str(tmp_path / "late"),
    ).awaitTermination()

    def pairs(name):
        rows = spark.read.parquet(str(tmp_path / name)).collect()
        return sorted((r.payload["n"], r.channel) for r in rows)

    assert pairs("sent") == [("1", "email"), ("1", "push"), ("3", "email")]
    assert pairs("late") == [("3", "push"), ("9", "email"), ("9", "push")]


def test_log_files_are_enriched_as_they_come(spark, tmp_path):
    folder = tmp_path / "var/log/pods/u1/app"
    folder.mkdir(parents=True)
    (folder / "0.log").write_text('{"level":"ERROR"}\n')
    pods = spark.createDataFrame(
        [("u1", "ns", "p", "app", "svc", "Running")],
        "uid string, namespace string, pod string, container string, app string, phase string")
    lines = stream_log_files(spark, f"{tmp_path}/var/log/pods/*/*/*.log")
    enriched = lg.enrich(with_file_keys(lines), pod_targets(pods))
    pipelines.append_stream(enriched, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert (row.namespace, row.pod, row.app, row.line) == ("ns", "p", "svc", '{"level":"ERROR"}')
