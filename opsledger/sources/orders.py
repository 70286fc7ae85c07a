"""Order table sources."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from opsledger.model import ORDERS


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Stored orders; a table written by ``append_orders`` also has its date partition."""
    return spark.read.schema(ORDERS).parquet(path)


def read_orders_jdbc(
    spark: SparkSession,
    url: str,
    start: datetime,
    end: datetime,
    partitions: int,
    table: str = "orders",
    **options: str,
) -> DataFrame:
    """Orders from a database, read in parallel slices of ``created_at``.

    The bounds only place the slices: rows outside them are still read, by the
    first and the last slice. The driver jar for ``url`` must be on the classpath.
    """
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", "created_at")
        .option("lowerBound", start.isoformat(sep=" "))
        .option("upperBound", end.isoformat(sep=" "))
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )
