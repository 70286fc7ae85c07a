"""Schema contract of the order table as checks over the whole table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.model import ORDERS, STATUSES


def null_counts(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Nulls per required column, all in one pass: ``column_name, null_count``."""
    required = required or ORDERS.names
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    lines = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in required]
    )
    return counts.select(F.inline(lines))


def duplicate_keys(df: DataFrame, key: str = "id") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def uniqueness(df: DataFrame, key: str = "id") -> DataFrame:
    """One row: rows, distinct keys, keys stored more than once, surplus rows."""
    per_key = df.groupBy(key).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("copies") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
    )


def domain_counts(df: DataFrame, column: str = "status", allowed: tuple = STATUSES) -> DataFrame:
    """Rows per value and whether the value is allowed; null is not."""
    return (
        df.groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .withColumn("allowed", F.coalesce(F.col(column).isin(*allowed), F.lit(False)))
    )
