"""Report files, one folder per period; writing a period again replaces it."""

from pyspark.sql import DataFrame

from opsledger.functions.workspace import stored
from opsledger.operators.orders import report_document, report_html, report_long

_PERIOD = ["period_start_date", "period_end_date"]


def _writer(reports: DataFrame):
    return (
        reports.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_PERIOD)
    )


def write_json_reports(summaries: DataFrame, path: str) -> None:
    _writer(report_document(summaries)).json(path)


def write_csv_reports(summaries: DataFrame, path: str) -> None:
    """``metric,value`` files whose six rows keep their order."""
    rows = (
        report_long(summaries)
        .repartition(*_PERIOD)
        .sortWithinPartitions(*_PERIOD, "ordinal")
        .drop("ordinal")
    )
    _writer(rows).option("header", True).csv(path)


def write_html_reports(summaries: DataFrame, path: str) -> None:
    _writer(report_html(summaries)).text(path)


def write_reports(summaries: DataFrame, path: str) -> None:
    """JSON and CSV of the same summaries, which are computed only once."""
    kept = stored(summaries, "summaries")
    write_json_reports(kept, f"{path}/json")
    write_csv_reports(kept, f"{path}/csv")
