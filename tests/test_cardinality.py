"""Label sets counted from stored states."""

import random
from datetime import datetime, timedelta

from opsledger.functions.timegrid import BUCKET
from opsledger.operators import cardinality
from opsledger.streaming import pipelines

T0 = datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, metric string, a string, b long"


def _rows(n, values, seed=2):
    rng = random.Random(seed)
    return [
        (T0 + timedelta(minutes=rng.randrange(24 * 60)), rng.choice(["m", "m", "m", None]),
         rng.choice(["x", None]), rng.randrange(values)) for _ in range(n)
    ]


def _expected(rows, hours):
    found = {}
    for ts, metric, a, b in rows:
        hour = ts.replace(minute=0)
        for end in range(1, hours + 1):
            found.setdefault((metric, hour + timedelta(hours=end)), set()).add((a, b))
    return {k: len(v) for k, v in found.items()}


def test_few_label_sets_are_exact_and_many_within_the_error(spark):
    for values, lg_k in ((20, 12), (6000, 11)):
        rows = _rows(8000, values)
        states = cardinality.label_states(spark.createDataFrame(rows, SCHEMA), ["metric"], ["a", "b"], 3600, lg_k=lg_k)
        found = cardinality.windowed_cardinality(states, ["metric"], 6 * 3600, 3600).collect()
        expected = _expected(rows, 6)
        assert {(r.metric, r.window_end) for r in found} == expected.keys()
        bound = 0 if values == 20 else 4 * cardinality.error_of(lg_k)
        for r in found:
            true = expected[r.metric, r.window_end]
            assert abs(r.n_series - true) <= bound * true
        day = cardinality.cardinality_between(states, ["metric"], T0 + timedelta(hours=3), T0 + timedelta(hours=9)).collect()
        assert len(day) == 2
        for r in day:
            true = expected[r.metric, T0 + timedelta(hours=9)]
            assert abs(r.n_series - true) <= bound * true


def test_streamed_states_unite(spark, tmp_path):
    rows, out, c = _rows(600, 30), str(tmp_path / "out"), str(tmp_path / "c")
    for part in range(10):
        spark.createDataFrame(rows[part::10], SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{part}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    pipelines.label_state_stream(stream, ["metric"], ["a", "b"], 3600, out, c).awaitTermination()
    states = pipelines.stored_buckets(spark, out, c)
    assert len(states.inputFiles()) < 10 and states.select(BUCKET).distinct().count() == 24
    found = cardinality.windowed_cardinality(states, ["metric"], 3 * 3600, 3600).collect()
    assert {(r.metric, r.window_end): r.n_series for r in found} == _expected(rows, 3)
