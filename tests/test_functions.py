from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from opsledger.functions import text
from opsledger.functions.joins import fits_broadcast, lookup_join
from opsledger.functions.timegrid import in_range, moment
from opsledger.functions.workspace import new_folder, shared_folder, stored


def _one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_iso_prints_a_fraction_only_when_there_is_one(spark):
    assert _one(spark, text.iso_timestamp(F.lit(datetime(2024, 1, 1)))) == "2024-01-01T00:00:00+00:00"
    assert _one(spark, text.iso_timestamp(F.lit(datetime(2024, 1, 1, 1, 2, 3, 40)))) == (
        "2024-01-01T01:02:03.000040+00:00")


@pytest.mark.parametrize("value, shown", [(0.25, "0.2"), (0.75, "0.8"), (33.333, "33.3"), (100.0, "100.0")])
def test_one_decimal(spark, value, shown):
    assert _one(spark, text.one_decimal(F.lit(value))) == shown


@pytest.mark.parametrize("value, width", [(0.5, 0), (1.5, 2), (59.6, 60)])
def test_bar_width(spark, value, width):
    assert _one(spark, text.bar_width(F.lit(value))) == width


def test_html_escape(spark):
    assert _one(spark, text.html_escape(F.lit("<a href=\"x\">&'"))) == "&lt;a href=&#34;x&#34;&gt;&amp;&#39;"


@pytest.mark.parametrize("ratio, shown", [(0.2, "20%"), (0.1234567, "12.35%"), (1.0, "100%"), (0.0, "0%")])
def test_percent(spark, ratio, shown):
    assert _one(spark, text.percent_text(F.lit(ratio))) == shown


@pytest.mark.parametrize(
    "seconds, shown", [(2.5, "2.5s"), (0.12, "120ms"), (90.0, "1m 30s"), (3723.0, "1h 2m 3s"), (86400.0, "1d 0h 0m 0s")])
def test_duration(spark, seconds, shown):
    assert _one(spark, text.duration_text(F.lit(seconds))) == shown


def test_map_get(spark):
    mapping = F.create_map(F.lit("a"), F.lit("1"))
    assert _one(spark, text.map_get(mapping, "a", "x")) == "1"
    assert _one(spark, text.map_get(mapping, "b", "x")) == "x"


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_rows", [0, 100])
def test_lookup_join_equals_a_plain_join(spark, how, max_rows):
    big = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("k"), "id")
    small = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = sorted(map(str, big.join(small, "k", how).collect()))
    assert sorted(map(str, lookup_join(big, small, ["k"], how, max_rows=max_rows).collect())) == plain


def test_salted_join_spreads_one_hot_key(spark):
    big = spark.range(0, 8000, numPartitions=4).select(F.lit(1).alias("k"))
    small = spark.createDataFrame([(1, "x")], "k int, v string")
    salted = lookup_join(big, small, ["k"], max_rows=0, salts=16)
    sides = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in sides
    assert salted.count() == 8000
    # Equal rows differ by the partition they are in.
    from opsledger.functions.joins import row_salt

    assert big.select(row_salt(big, 16).alias("s")).distinct().count() == 4


def test_salted_copies_are_not_broadcast(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "keys"))
    small = spark.read.parquet(str(tmp_path / "keys")).distinct()
    salted = lookup_join(spark.range(2000), small, ["id"], "left_semi", max_rows=10)
    assert salted.count() == 1000
    assert "Broadcast" not in salted._jdf.queryExecution().executedPlan().toString()


def test_lookup_join_refuses_joins_it_cannot_salt(spark):
    with pytest.raises(ValueError):
        lookup_join(spark.range(1), spark.range(1), ["id"], "full")


def test_size_check_sees_rows_and_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert fits_broadcast(wide, 100, 10**6)
    assert not fits_broadcast(wide, 99, 10**6)
    assert not fits_broadcast(wide, 100, 10**4)
    assert fits_broadcast(wide.limit(0))


def test_workspace(spark):
    assert new_folder(spark, "a") != new_folder(spark, "a")
    assert new_folder(spark, "a").startswith(shared_folder(spark))
    kept = stored(spark.range(3), "numbers")
    assert kept.count() == 3 and kept.inputFiles()


def test_python_times_are_utc(spark):
    naive = datetime(2024, 1, 1, 6, 0, 0, 5)
    ahead = datetime(2024, 1, 1, 8, 0, 0, 5, timezone(timedelta(hours=2)))
    for value in (naive, ahead, naive.replace(tzinfo=timezone.utc)):
        assert _one(spark, moment(value).cast("string")) == "2024-01-01 06:00:00.000005"


def test_other_session_zones_are_refused(spark):
    frame = spark.createDataFrame([(datetime(2024, 1, 1),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            in_range(frame, "ts", datetime(2024, 1, 1), datetime(2024, 1, 2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
