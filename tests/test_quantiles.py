"""Weighted quantiles: summaries, brackets and exact values, with weights beyond any expansion."""

import random
from collections import Counter
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from opsledger.functions.timegrid import BUCKET
from opsledger.operators import quantiles

T0 = datetime(2024, 1, 1)
HUGE = 10**10


def plain_quantile(weights: Counter, q):
    """By cumulative weights in exact arithmetic."""
    place = Fraction(str(q)) * (sum(weights.values()) - 1)
    ends = []
    for rank in (place.__floor__(), place.__ceil__()):
        upto = 0
        for value in sorted(weights):
            upto += weights[value]
            if rank < upto:
                ends.append(value)
                break
    return ends[0] + (ends[1] - ends[0]) * float(place - place.__floor__())


def sample(seed=3, n=600):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = rng.choice(["hot", "hot", "hot", "cold", None])
        value = rng.choice([rng.lognormvariate(0, 3), float(rng.randint(0, 5)), -rng.random()])
        rows.append((key, rng.randrange(48), value, rng.choice([1, 2, 1000, HUGE, 3 * HUGE + 1])))
    return rows + [("one", 5, 2.0, HUGE), ("two", 5, 1.0, 1), ("two", 5, 3.0, 1)]


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 0.999, 1.0])
def test_weights_beyond_any_expansion(spark, q):
    rows = sample()
    expected = {}
    for key, _, value, weight in rows:
        expected.setdefault(key, Counter())[value] += weight
    frame = spark.createDataFrame([(k, v, w) for k, _, v, w in rows], "k string, v double, w long")
    frame = frame.unionByName(spark.createDataFrame([("hot", None, 5), ("hot", 9.0, 0), ("void", 9.0, None)], frame.schema))
    found = {r.k: r["quantile"] for r in quantiles.exact_quantile(frame, ["k"], "v", q, 0, "w").collect()}
    assert found == pytest.approx({k: plain_quantile(c, q) for k, c in expected.items()}, rel=1e-12)


def bucketed(spark, rows):
    frame = spark.createDataFrame(
        [(k, T0 + timedelta(hours=h), v, w) for k, h, v, w in rows], f"k string, {BUCKET} timestamp_ntz, v double, w long")
    return frame.groupBy("k", BUCKET, "v").agg(F.sum("w").alias("w"))


def plain_windows(rows, hours):
    windows = {}
    for key, hour, value, weight in rows:
        for end in range(hour + 1, hour + 1 + hours):
            windows.setdefault((key, T0 + timedelta(hours=end)), Counter())[value] += weight
    return windows


@pytest.mark.parametrize("small_group, points", [(0, 4), (0, 64), (20 * HUGE, 16)])
def test_windows_equal_the_plain_quantile(spark, small_group, points):
    rows = sample(4)
    found = quantiles.windowed_quantile(
        bucketed(spark, rows), ["k"], 0.9, 6 * 3600, 3600, small_group, points)
    values = {(r.k, r.window_end): r["quantile"] for r in found.collect()}
    expected = {key: plain_quantile(c, 0.9) for key, c in plain_windows(rows, 6).items()}
    # Spark's own percentile adds up the small groups' weights as doubles
    assert values == pytest.approx(expected, rel=1e-6)


@pytest.mark.parametrize("points", [2, 16])
def test_summaries_are_small_and_bound_the_ranks(spark, points):
    rows = sample(5, 2000)
    cuts = quantiles.quantile_summary(bucketed(spark, rows), ["k", BUCKET], points)
    known = {r.v for r in cuts.collect()}
    sizes = cuts.groupBy("k", BUCKET).count().agg(F.max("count")).first()[0]
    assert sizes <= points + 1
    bounds = quantiles.quantile_bounds(cuts, ["k"], 0.5, 6 * 3600, 3600).collect()
    windows = plain_windows(rows, 6)
    assert {(r.k, r.window_end) for r in bounds} == set(windows)
    for r in bounds:
        weights = windows[r.k, r.window_end]
        total = sum(weights.values())
        assert r.total == total
        below = sum(w for v, w in weights.items() if r.low is not None and v <= r.low)
        upto = sum(w for v, w in weights.items() if v <= r.high)
        assert below <= r.low_rank and r.high_rank < upto
        # beside the cut points, of exact weight, the error of both ends is inside
        inside = sum(w for v, w in weights.items() if (r.low is None or v > r.low) and v < r.high and v not in known)
        assert inside <= 4 * total / points + 1


def test_no_rows(spark):
    empty = bucketed(spark, sample()).limit(0)
    assert quantiles.windowed_quantile(empty, ["k"], 0.5, 3600, 3600, 0).count() == 0
    assert quantiles.exact_quantile(empty, ["k"], "v", 0.5, 0, "w").count() == 0


def test_no_labels(spark):
    rows = sample(6)
    found = quantiles.windowed_quantile(
        bucketed(spark, rows).groupBy(BUCKET, "v").agg(F.sum("w").alias("w")), [], 0.5, 6 * 3600, 3600, 0, 8)
    expected = plain_windows([(None, h, v, w) for _, h, v, w in rows], 6)
    assert {r.window_end: r["quantile"] for r in found.collect()} == pytest.approx(
        {end: plain_quantile(c, 0.5) for (_, end), c in expected.items()}, rel=1e-12)


def test_a_quantile_outside_the_unit_interval(spark):
    with pytest.raises(ValueError):
        quantiles.exact_quantile(bucketed(spark, sample()), ["k"], "v", 1.5)
