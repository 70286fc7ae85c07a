"""What the optimizer makes of the main queries."""

import pytest

import __spark_entry__ as contract
from opsledger.functions.joins import fits_broadcast

QUERIES = contract.queries()


@pytest.fixture()
def plan(spark, sf, capsys):
    def explain(name):
        QUERIES[name](spark, sf).explain("formatted")
        return capsys.readouterr().out

    return explain


def test_summary_reads_two_columns_of_one_period(plan):
    text = plan("order_summary")
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in text
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in text
    assert "LessThan(o_orderdate,1998-01-08T00:00)" in text
    assert "lineitem" not in text and "partial_count" in text


def test_counts_do_not_shuffle_rows(plan):
    for name in ("request_counts", "latency_histogram", "error_ratio", "report_sliding"):
        text = plan(name)
        assert text.index("partial_") < len(text)
        assert "SortMergeJoin" not in text


def test_routing_does_not_shuffle(plan):
    for name in ("route_events", "notifications", "logs_enriched"):
        text = plan(name)
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_period_filter_reaches_the_scan(plan):
    assert "GreaterThanOrEqual(ts,2024-01-15T06:00)" in plan("log_last_hours")


def test_tail_cuts_before_the_shuffle(plan):
    text = plan("log_tail")
    assert text.count("WindowGroupLimit") >= 2 and "TakeOrderedAndProject" in text


def test_lookup_filters_by_key_before_it_aggregates(plan):
    text = plan("orders_lookup")
    assert text.index("LeftSemi") > 0 and "BroadcastHashJoin LeftSemi" in text


def test_size_is_measured_without_gathering_rows(spark, capsys, monkeypatch):
    plans = []
    frame = type(spark.range(1))
    real = frame.first
    monkeypatch.setattr(frame, "first", lambda self: (plans.append(self._jdf.queryExecution().toString()), real(self))[1])
    assert fits_broadcast(spark.range(100))
    assert "Limit" not in plans[0] and "partial_count" in plans[0]


def test_quantiles_repeat_counts_not_lines(plan):
    assert "percentile(v" in plan("log_quantile")


def test_samples_are_sorted_per_chunk(plan):
    text = plan("counter_delta")
    assert "__chunk" in text and "Join" not in text
