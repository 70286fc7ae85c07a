"""Counters and histograms as text, one sample per line, as a scrape would read them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _label(name: str, value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit(""))
    for char, escape in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
        text = F.replace(text, F.lit(char), F.lit(escape))
    return F.concat(F.lit(f'{name}="'), text, F.lit('"'))


def _number(value: Column) -> Column:
    """Whole numbers without a fraction, infinity as ``+Inf``."""
    double = value.cast("double")
    whole = (double == F.floor(double)) & (F.abs(double) < 1e15)
    return (
        F.when(double == float("inf"), "+Inf")
        .when(whole, double.cast("bigint").cast("string"))
        .otherwise(double.cast("string"))
    )


def sample_line(metric: str, labels: list[str], value: Column, **extra: Column) -> Column:
    """``metric{label="value",...} number`` with escaped label values."""
    parts = [_label(name, F.col(name)) for name in labels]
    parts += [_label(name, column) for name, column in extra.items()]
    if not parts:
        return F.concat(F.lit(f"{metric} "), _number(value))
    return F.concat(
        F.lit(f"{metric}{{"), F.concat_ws(",", *parts), F.lit("} "), _number(value)
    )


def counter_lines(counts: DataFrame, metric: str, labels: list[str], value: str = "n") -> DataFrame:
    return counts.select(sample_line(metric, labels, F.col(value)).alias("line"))


def histogram_lines(histogram: DataFrame, metric: str, labels: list[str]) -> DataFrame:
    """Bucket, sum and count lines of ``latency_histogram`` rows."""
    bucket = sample_line(
        f"{metric}_bucket", labels, F.col("cum_count"), le=_number(F.col("le"))
    )
    totals = F.array(
        sample_line(f"{metric}_sum", labels, F.col("observed_sum")),
        sample_line(f"{metric}_count", labels, F.col("observations")),
    )
    last = F.col("le") == float("inf")
    lines = F.when(last, F.concat(F.array(bucket), totals)).otherwise(F.array(bucket))
    return histogram.select(F.explode(lines).alias("line"))
