"""Duplicate removal without a time limit."""

import json
from datetime import datetime, timedelta

import pytest

from opsledger.streaming import pipelines
from opsledger.streaming.keystore import KeyStore

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, note string"


def _store(spark, folder, **options):
    (folder / "c").mkdir(exist_ok=True)
    (folder / "c" / "metadata").write_text(json.dumps({"id": "one"}))
    return KeyStore(spark, str(folder / "keys"), str(folder / "c"), **options)


def _keys(spark, names, scope="all", batch=None):
    if batch is None:
        return spark.createDataFrame([(n, scope) for n in names], "key string, scope string")
    return spark.createDataFrame([(n, batch, scope) for n in names], "key string, batch long, scope string")


def test_known_keys_and_few_opened_folders(spark, tmp_path):
    store = _store(spark, tmp_path, buckets=8, fan_in=4)
    assert store.known(_keys(spark, ["a"]), 0).count() == 0
    for i in range(6):
        store.add(_keys(spark, [f"k{i}-{j}" for j in range(500)], "all" if i % 2 else "2024-01-01", i), i)
    assert len(store.live()) == 3
    asked = ["k1-7", "k3-400", "k5-0", "k5-499", "new", "k0-1"]
    assert sorted(r.key for r in store.known(_keys(spark, asked), 6).collect()) == ["k1-7", "k3-400", "k5-0", "k5-499"]
    # k0-1 has another scope; five keys that are there open no more than their own folders and a chance hit
    assert store.opened <= 6
    assert [r.key for r in store.known(_keys(spark, ["k0-1", "k1-7"], "2024-01-01"), 6).collect()] == ["k0-1"]
    # a micro-batch that is replayed does not find itself
    assert sorted(r.key for r in store.known(_keys(spark, asked), 5).collect()) == ["k1-7", "k3-400"]
    strangers = [f"x{j}" for j in range(2000)]
    assert store.maybe(_keys(spark, strangers)).count() < 40
    assert store.known(_keys(spark, strangers), 6).count() == 0
    assert store.maybe(_keys(spark, [f"k3-{j}" for j in range(500)])).select("key").distinct().count() == 500


def _run(spark, folder, rows, **options):
    if rows:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(folder / "in"))
    pipelines.dedup_all_stream(stream, str(folder / "out"), str(folder / "c"), fan_in=2, **options).awaitTermination()
    found = spark.read.parquet(str(folder / "out" / "events")).collect()
    return sorted((r.event_id or 0, r.ts, r.note) for r in found)


def test_copies_weeks_apart(spark, tmp_path):
    week = timedelta(days=7)
    first = [(1, T0, "a"), (1, T0, "b"), (2, T0 + week, "c"), (None, T0, "n"), (None, T0, "n")]
    kept = [(0, T0, "n"), (0, T0, "n"), (1, T0, "a"), (2, T0 + week, "c")]
    assert _run(spark, tmp_path, first) == kept
    later = [(1, T0 + 9 * week, "late"), (2, T0, "early"), (3, T0 - 50 * week, "very old")]
    kept = sorted([*kept, (3, T0 - 50 * week, "very old")])
    assert _run(spark, tmp_path, later) == kept
    assert _run(spark, tmp_path, [(3, T0, "again"), (4, T0, "new")]) == sorted([*kept, (4, T0, "new")])
    assert _run(spark, tmp_path, [(4, T0, "x"), (1, T0, "x")]) == sorted([*kept, (4, T0, "new")])


def test_a_failed_micro_batch_is_replayed_whole(spark, tmp_path, monkeypatch):
    assert _run(spark, tmp_path, [(1, T0, "a")]) == [(1, T0, "a")]
    real = KeyStore.add

    def fails_after(self, rows, batch_id):
        real(self, rows, batch_id)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(KeyStore, "add", fails_after)
    with pytest.raises(Exception, match="driver lost"):
        _run(spark, tmp_path, [(1, T0, "copy"), (2, T0, "b")])
    monkeypatch.setattr(KeyStore, "add", real)
    # its keys are stored already, but they are its own
    assert _run(spark, tmp_path, []) == [(1, T0, "a"), (2, T0, "b")]
