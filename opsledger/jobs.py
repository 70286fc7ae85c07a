"""Command line jobs: the scheduled order report and the notification stream.

``python -m opsledger.jobs report --orders PATH --output PATH [--days 7] [--as-of TIME]``
``python -m opsledger.jobs route --messages PATH --output PATH [--rules FILE] [--every TIME]
[--max-files N]``
"""

import argparse
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from opsledger.functions.workspace import drop_intermediates
from opsledger.operators.orders import REPORT_PERIOD_DAYS, order_summary
from opsledger.sinks.reports import write_reports
from opsledger.sources.messages import stream_messages
from opsledger.sources.orders import read_orders
from opsledger.sources.rules import NOTIFICATION_RULES, default_channels, load_rules, rules_table
from opsledger.streaming.pipelines import route_messages


def report(
    spark: SparkSession,
    orders: str,
    output: str,
    days: int = REPORT_PERIOD_DAYS,
    as_of: datetime | None = None,
) -> None:
    """Summarise the period that ends at ``as_of`` and write it as JSON and CSV."""
    write_reports(order_summary(read_orders(spark, orders), days, as_of), output)


def route(
    spark: SparkSession,
    messages: str,
    output: str,
    rules: str | None = None,
    every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Route message files by the rules, once or ``every`` so often.

    ``max_files`` bounds a micro-batch; by default it takes all there is, in parallel.
    """
    config = load_rules(rules) if rules else NOTIFICATION_RULES
    return route_messages(
        stream_messages(spark, messages, max_files),
        rules_table(spark, config),
        default_channels(config),
        f"{output}/notifications",
        f"{output}/dead_letters",
        f"{output}/checkpoint",
        {"processingTime": every} if every else None,
    )


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="opsledger.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    summary = jobs.add_parser("report")
    summary.add_argument("--orders", required=True)
    summary.add_argument("--output", required=True)
    summary.add_argument("--days", type=int, default=REPORT_PERIOD_DAYS)
    summary.add_argument("--as-of", type=datetime.fromisoformat)
    routing = jobs.add_parser("route")
    routing.add_argument("--messages", required=True)
    routing.add_argument("--output", required=True)
    routing.add_argument("--rules")
    routing.add_argument("--every")
    routing.add_argument("--max-files", type=int)
    chosen = parser.parse_args(arguments)

    spark = (
        SparkSession.builder.appName(f"opsledger-{chosen.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if chosen.job == "report":
        report(spark, chosen.orders, chosen.output, chosen.days, chosen.as_of)
    else:
        route(
            spark, chosen.messages, chosen.output, chosen.rules, chosen.every, chosen.max_files
        ).awaitTermination()
    drop_intermediates(spark)


if __name__ == "__main__":
    main()
