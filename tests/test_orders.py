import csv
import json
from datetime import date, datetime

import pytest

from opsledger.operators import orders as od
from opsledger.operators import quality
from opsledger.sinks.reports import write_csv_reports, write_html_reports, write_json_reports
from opsledger.sinks.tables import append_orders
from opsledger.sources.orders import read_orders

START, END = datetime(2024, 1, 1), datetime(2024, 1, 8)
ORDER = "id string, customer_id string, product_id string, quantity int, status string, created_at timestamp_ntz"


def _orders(spark, rows):
    return spark.createDataFrame(
        [(str(i), "c", "p", 1, status, at) for i, (status, at) in enumerate(rows)], ORDER
    )


@pytest.fixture()
def summary(spark):
    return spark.createDataFrame(
        [(10, 3, 6, 1, START, END)],
        "total_orders long, pending long, confirmed long, cancelled long, "
        "period_start timestamp, period_end timestamp",
    )


def test_period_is_half_open_and_total_counts_any_status(spark):
    orders = _orders(
        spark,
        [
            ("pending", START),
            ("confirmed", datetime(2024, 1, 7, 23, 59, 59, 999999)),
            ("pending", END),
            ("cancelled", datetime(2023, 12, 31, 23, 59, 59)),
            ("returned", datetime(2024, 1, 3)),
        ],
    )
    row = od.order_summary(orders, 7, END).first()
    assert (row.total_orders, row.pending, row.confirmed, row.cancelled) == (3, 1, 1, 0)
    assert (row.period_start, row.period_end) == (START, END)


def test_empty_period_is_one_row_of_zeros(spark):
    row = od.order_summary(_orders(spark, [("pending", END)]), 7, datetime(2020, 1, 1)).collect()
    assert [tuple(r)[:4] for r in row] == [(0, 0, 0, 0)]


def test_default_period_ends_now(spark):
    row = od.order_summary(_orders(spark, [("pending", datetime.now().replace(year=2000))])).first()
    assert (row.period_end - row.period_start).days == 7
    assert row.total_orders == 0


def test_json_report(spark, summary, tmp_path):
    path = tmp_path / "reports" / "2024" / "january"
    write_json_reports(summary, str(path))
    write_json_reports(summary, str(path))
    files = list(path.rglob("*.json"))
    assert len(files) == 1
    assert "period_start_date=2024-01-01" in str(files[0])
    assert "period_end_date=2024-01-08" in str(files[0])
    assert json.loads(files[0].read_text()) == {
        "period_start": "2024-01-01T00:00:00+00:00",
        "period_end": "2024-01-08T00:00:00+00:00",
        "total_orders": 10,
        "by_status": {"pending": 3, "confirmed": 6, "cancelled": 1},
    }


def test_rerun_replaces_only_its_own_period(spark, summary, tmp_path):
    from pyspark.sql import functions as F

    later = summary.withColumn("period_end", F.expr("period_end + INTERVAL 1 DAY"))
    write_json_reports(summary, str(tmp_path / "r"))
    write_json_reports(later, str(tmp_path / "r"))
    write_json_reports(later.withColumn("total_orders", F.lit(11)), str(tmp_path / "r"))
    stored = spark.read.json(str(tmp_path / "r"))
    assert sorted(r.total_orders for r in stored.collect()) == [10, 11]


def test_csv_report(spark, summary, tmp_path):
    write_csv_reports(summary, str(tmp_path / "r"))
    (file,) = (tmp_path / "r").rglob("*.csv")
    assert list(csv.reader(file.read_text().splitlines())) == [
        ["metric", "value"],
        ["period_start", "2024-01-01T00:00:00+00:00"],
        ["period_end", "2024-01-08T00:00:00+00:00"],
        ["total_orders", "10"],
        ["pending", "3"],
        ["confirmed", "6"],
        ["cancelled", "1"],
    ]


def test_csv_keeps_row_order_for_many_periods(spark, tmp_path):
    orders = _orders(spark, [("pending", datetime(2024, 1, d)) for d in range(1, 29)])
    write_csv_reports(od.sliding_summary(orders), str(tmp_path / "r"))
    files = list((tmp_path / "r").rglob("*.csv"))
    assert len(files) == 34
    for file in files:
        assert [line.split(",")[0] for line in file.read_text().splitlines()] == [
            "metric", "period_start", "period_end", "total_orders", "pending", "confirmed", "cancelled",
        ]


def test_html_report(spark, summary, tmp_path):
    write_html_reports(summary, str(tmp_path / "r"))
    (file,) = (tmp_path / "r").rglob("*.txt")
    html = file.read_text(encoding="utf-8")
    for part in ("Order Summary Report", "2024-01-01", "2024-01-08", "2024-01-08 00:00 UTC",
                 "pending", "confirmed", "cancelled", "<td>60.0%</td>", "width: 60%", "<td>10</td>"):
        assert part in html


def test_shares(spark, summary):
    rows = od.status_shares(summary).orderBy("ordinal").collect()
    assert [(r.status, r.n_orders, r.pct) for r in rows] == [
        ("pending", 3, 30.0), ("confirmed", 6, 60.0), ("cancelled", 1, 10.0), ("total", 10, 100.0),
    ]


def test_shares_without_orders_and_with_other(spark):
    empty = od.order_summary(_orders(spark, [("pending", END)]), 7, datetime(2020, 1, 1))
    assert [r.pct for r in od.status_shares(empty).orderBy("ordinal").collect()] == [0, 0, 0, 100]
    odd = od.order_summary(_orders(spark, [("returned", START), ("pending", START)]), 7, END)
    shares = {r.status: r.pct for r in od.status_shares(odd, with_other=True).collect()}
    assert shares == {"pending": 50, "confirmed": 0, "cancelled": 0, "other": 50, "total": 100}


def test_sliding_equals_one_summary_per_run(spark):
    orders = _orders(
        spark,
        [("pending", datetime(2024, 1, 1, 5, 59)), ("confirmed", datetime(2024, 1, 1, 6, 0)),
         ("pending", datetime(2024, 1, 4, 12)), ("x", datetime(2024, 1, 9, 6))],
    )
    for r in od.sliding_summary(orders).collect():
        one = od.order_summary(orders, 7, r.period_end).first()
        assert (r.total_orders, r.pending, r.confirmed, r.cancelled, r.period_start) == (
            one.total_orders, one.pending, one.confirmed, one.cancelled, one.period_start)
        assert (r.period_end.hour, r.period_end.minute) == (6, 0)


def test_empty_periods_are_listed(spark):
    orders = _orders(spark, [("pending", datetime(2024, 1, 1)), ("pending", datetime(2024, 1, 31))])
    totals = [r.total_orders for r in od.sliding_summary(orders).orderBy("period_end").collect()]
    assert totals == [1] * 7 + [0] * 23 + [1] * 7


def test_half_hourly_schedule_over_one_day(spark):
    orders = _orders(spark, [("pending", datetime(2024, 1, 1, 5, 59))])
    runs = od.sliding_summary(orders, od.DAY_S, 1800, 0).collect()
    assert len(runs) == 48
    assert min(r.period_end for r in runs) == datetime(2024, 1, 1, 6)


def test_lookup(spark):
    orders = spark.createDataFrame(
        [("order-123", "customer-1", "product-1", 2, "pending", START)], ORDER
    )
    keys = spark.createDataFrame([("order-123",), ("does-not-exist",), ("order-123",)], "id string")
    assert sorted(map(tuple, od.lookup_orders(keys, orders).collect())) == [
        ("does-not-exist", False, None, None), ("order-123", True, "pending", "customer-1"),
    ]


def test_lookup_of_a_repeated_id_fails(spark):
    orders = spark.createDataFrame([("a", "c", "p", 2, "pending", START)] * 2, ORDER)
    with pytest.raises(Exception, match="more than one order has id a"):
        od.lookup_orders(spark.createDataFrame([("a",)], "id string"), orders).collect()
    others = spark.createDataFrame([("b",)], "id string")
    assert od.lookup_orders(others, orders).first().found is False
    with pytest.raises(Exception, match="more than one order has id a"):
        od.lookup_orders(spark.createDataFrame([("a",)], "id string"), orders).select("status").collect()


def test_requests_are_typed_and_refused(spark):
    requests = spark.createDataFrame(
        [("c", "p", "2", None), ("c", "p", "0", "confirmed"), ("c", "p", "-1", None),
         ("c", "p", "x", None), (None, "p", "1", None), ("c", None, "1", None), ("c", "p", None, None)],
        "customer_id string, product_id string, quantity string, status string",
    )
    rows = od.validate_requests(requests).collect()
    assert [r.accepted for r in rows] == [True, True, True, False, False, False, False]
    assert rows[3].reason == "quantity not an integer"


def test_append_gives_defaults_and_distinct_ids(spark, tmp_path):
    requests = spark.createDataFrame(
        [("c", "p", "2", None), ("c", "p", "0", "confirmed"), ("c", "p", "x", None)],
        "customer_id string, product_id string, quantity string, status string",
    )
    append_orders(requests, str(tmp_path / "orders"), START)
    append_orders(requests, str(tmp_path / "orders"), START)
    stored = read_orders(spark, str(tmp_path / "orders"))
    rows = stored.collect()
    assert sorted(r.status for r in rows) == ["confirmed", "confirmed", "pending", "pending"]
    assert len({r.id for r in rows}) == 4 and all(len(r.id) == 36 for r in rows)
    assert {r.created_at for r in rows} == {START}
    refused = spark.read.parquet(str(tmp_path / "orders_rejected")).collect()
    assert [(r.quantity, r.reason) for r in refused] == [("x", "quantity not an integer")] * 2
    events = od.created_events(stored).collect()
    assert {e.event_type for e in events} == {"order.created"}
    assert {e.payload["order_id"] for e in events} == {r.id for r in rows}


def test_stored_orders_are_pruned_by_date(spark, tmp_path, capsys):
    schema = "customer_id string, product_id string, quantity string, created_at timestamp"
    days = [("c", "p", "1", datetime(2024, 1, d, 12)) for d in range(1, 11)]
    append_orders(spark.createDataFrame(days, schema), str(tmp_path / "orders"))
    stored = read_orders(spark, str(tmp_path / "orders"))
    period = od.orders_in_period(stored, datetime(2024, 1, 3), datetime(2024, 1, 5))
    assert sorted(r.created_at.day for r in period.collect()) == [3, 4]
    assert od.order_summary(stored, 7, datetime(2024, 1, 8)).first().total_orders == 7
    period.explain("formatted")
    assert "PartitionFilters: [isnotnull(created_date" in capsys.readouterr().out


def test_quality_checks(spark):
    rows = [("a", "c", None, 1, "pending", START), ("a", "c", None, 1, "returned", START),
            ("b", "c", "p", None, None, START)]
    df = spark.createDataFrame(rows, ORDER)
    assert {r.column_name: r.null_count for r in quality.null_counts(df).collect()} == {
        "id": 0, "customer_id": 0, "product_id": 2, "quantity": 1, "status": 1, "created_at": 0}
    assert [tuple(r) for r in quality.duplicate_keys(df).collect()] == [("a", 2)]
    assert tuple(quality.uniqueness(df).first()) == (3, 2, 1, 1)
    domain = {r.status: (r.n_rows, r.allowed) for r in quality.domain_counts(df).collect()}
    assert domain == {"pending": (1, True), "returned": (1, False), None: (1, False)}


def test_report_document_dates(spark, summary):
    row = od.report_document(summary).first()
    assert (row.period_start_date, row.period_end_date) == (date(2024, 1, 1), date(2024, 1, 8))


def test_a_repeated_run_replaces_its_orders(spark, tmp_path):
    from opsledger.sinks.tables import publish_events

    schema = "customer_id string, product_id string, quantity string, status string"
    requests = spark.createDataFrame([("c", "p", "2", None), ("c", "p", "x", None)], schema)
    path = str(tmp_path / "orders")
    for run in ("a", "a", "b"):
        append_orders(requests, path, START, run=run)
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(f"{path}_rejected").count() == 2
    events = od.created_events(spark.read.parquet(path))
    for _ in range(2):
        publish_events(events, str(tmp_path / "events"), run="a")
    assert spark.read.text(str(tmp_path / "events")).count() == 2
