"""Append-only tables: orders, events, notifications, dead letters, alerts."""

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.model import CREATED_DATE
from opsledger.functions.workspace import stored
from opsledger.operators.orders import new_orders, rejected_requests
from opsledger.sources.messages import encode_events


def _by_folder(df: DataFrame, *keys: str):
    """A writer with few files per folder; a large folder is still written by many tasks."""
    return df.hint("rebalance", *keys).write.partitionBy(*keys)


def append_orders(
    requests: DataFrame,
    path: str,
    as_of: datetime | None = None,
    rejected: str | None = None,
    run: str | None = None,
) -> None:
    """Store accepted requests by date. Publish their events from the stored table only.

    Refused requests go to ``rejected``, by default beside the orders, with the reason. A named
    ``run`` that is repeated replaces the orders and refusals it stored before, under ``run=``;
    without a name each call adds to the table.
    """
    once = stored(requests, "order-requests")
    orders = new_orders(once, as_of).withColumn(CREATED_DATE, F.to_date("created_at"))
    _mode(_by_folder(orders, CREATED_DATE), run).parquet(_of_run(path, run))
    other = rejected or f"{path.rstrip('/')}_rejected"
    _mode(rejected_requests(once).write, run).parquet(_of_run(other, run))


def _of_run(path: str, run: str | None) -> str:
    return path if run is None else f"{path.rstrip('/')}/run={run}"


def _mode(writer, run: str | None):
    return writer.mode("append" if run is None else "overwrite")


def publish_events(events: DataFrame, path: str, run: str | None = None) -> None:
    """Envelopes as text, in one folder per routing key; a repeated ``run`` replaces its own."""
    bodies = encode_events(events).select("routing_key", F.col("body").alias("value"))
    _mode(_by_folder(bodies, "routing_key"), run).text(_of_run(path, run))


def publish_event_stream(events: DataFrame, path: str, checkpoint: str):
    """The same for a stream of stored orders; the file sink writes each row once."""
    return (
        encode_events(events)
        .select("routing_key", F.col("body").alias("value"))
        .writeStream.format("text")
        .partitionBy("routing_key")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def store_deliveries(deliveries: DataFrame, delivered: str, dead: str, run: str) -> None:
    """Deliveries that succeeded in one table, those out of attempts in another.

    Both come from one evaluation. A ``run`` that is repeated replaces what it stored.
    """
    once = stored(deliveries, "deliveries")
    once.where("delivered").write.mode("overwrite").parquet(f"{delivered}/run={run}")
    once.where("dead_letter").write.mode("overwrite").parquet(f"{dead}/run={run}")


def append_alerts(states: DataFrame, path: str, run: str) -> None:
    """Alert states with their text by date and alert; a repeated ``run`` replaces its own."""
    dated = states.withColumn("eval_date", F.to_date("eval_ts"))
    _by_folder(dated, "eval_date", "alert").mode("overwrite").parquet(f"{path}/run={run}")


def run_of(checkpoint: str) -> str:
    """Name of a stream's run: the same when it goes on from its checkpoint, another otherwise."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def write_batch(df: DataFrame, path: str, batch_id: int, run: str) -> None:
    """One folder per run and micro-batch: a replayed batch replaces what it wrote before."""
    df.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")
