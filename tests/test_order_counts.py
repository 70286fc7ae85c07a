"""Reports from kept counts equal reports from all orders, and read only what has changed."""

import random
import shutil
from datetime import datetime, timedelta

import pytest

from opsledger.operators import order_counts
from opsledger.operators.orders import sliding_summary
from opsledger.sinks.tables import append_orders

T0 = datetime(2024, 1, 1)
SCHEMA = "customer_id string, product_id string, quantity string, status string, created_at timestamp"


def _append(spark, path, days, n=40, seed=1):
    rng = random.Random(seed)
    rows = [
        ("c", "p", "1", rng.choice(["pending", "confirmed", "cancelled", "returned"]),
         T0 + timedelta(days=rng.choice(days), seconds=rng.randrange(86400))) for _ in range(n)
    ]
    append_orders(spark.createDataFrame(rows, SCHEMA), path)


def test_only_changed_partitions_are_counted(spark, tmp_path):
    path, table = str(tmp_path / "orders"), str(tmp_path / "counts")

    def refresh():
        counted = order_counts.refresh_counts(spark, spark.read.parquet(path), path, table)
        whole = sliding_summary(spark.read.parquet(path)).collect()
        assert sorted(order_counts.kept_summary(spark, table).collect()) == sorted(whole)
        return [c[-2:] for c in counted]

    with pytest.raises(FileNotFoundError):
        order_counts.kept_summary(spark, table)
    _append(spark, path, [0, 1, 2, 10])
    assert refresh() == ["01", "02", "03", "11"]
    assert refresh() == []
    _append(spark, path, [2, 3], seed=2)
    assert refresh() == ["03", "04"]
    # a day that is written again, and one that goes
    shutil.move(f"{path}/created_date=2024-01-11", str(tmp_path / "away"))
    shutil.rmtree(f"{path}/created_date=2024-01-01")
    _append(spark, path, [0], n=3, seed=3)
    assert refresh() == ["01"]
    assert refresh() == []
    shutil.move(str(tmp_path / "away"), f"{path}/created_date=2024-01-11")
    assert refresh() == ["11"]


def test_a_refresh_reads_only_the_changed_folders(spark, tmp_path, monkeypatch):
    path, table = str(tmp_path / "orders"), str(tmp_path / "counts")
    _append(spark, path, list(range(12)), n=100)
    order_counts.refresh_counts(spark, spark.read.parquet(path), path, table)
    _append(spark, path, [20], n=2, seed=5)
    plans, real = [], order_counts.with_bucket
    monkeypatch.setattr(order_counts, "with_bucket", lambda df, *a: (plans.append(df), real(df, *a))[1])
    order_counts.refresh_counts(spark, spark.read.parquet(path), path, table)
    scan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "2024-01-21" in scan.replace("19743", "2024-01-21")
