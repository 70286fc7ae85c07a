import json
from datetime import datetime

import pytest

from opsledger import jobs
from opsledger.sinks.tables import append_orders


def test_report_job(spark, tmp_path):
    schema = "customer_id string, product_id string, quantity string, status string, created_at timestamp"
    rows = [("c", "p", "1", s, datetime(2024, 1, 3)) for s in ("pending", "confirmed", None)]
    append_orders(spark.createDataFrame(rows, schema), str(tmp_path / "orders"))
    jobs.main(
        ["report", "--orders", str(tmp_path / "orders"), "--output", str(tmp_path / "out"),
         "--as-of", "2024-01-08T00:00:00"])
    (file,) = (tmp_path / "out" / "json").rglob("*.json")
    assert json.loads(file.read_text())["by_status"] == {"pending": 2, "confirmed": 1, "cancelled": 0}
    (file,) = (tmp_path / "out" / "csv").rglob("*.csv")
    assert "total_orders,3" in file.read_text()


def test_report_without_orders_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.report(spark, str(tmp_path / "missing"), str(tmp_path / "out"))


def test_route_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text('{"event_type":"a"}\n')
    rules = tmp_path / "rules.json"
    rules.write_text(json.dumps({"handlers": {"a": [{"type": "sms", "template": "t", "retry": 2}]}}))
    jobs.main(
        ["route", "--messages", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--rules", str(rules)])
    (row,) = spark.read.parquet(str(tmp_path / "out" / "notifications")).collect()
    assert (row.event_type, row.channel, row.template, row.retry) == ("a", "sms", "t", 2)
