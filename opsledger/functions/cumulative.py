"""Running sums over sorted values, with no group in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsledger.functions.joins import join_same
from opsledger.functions.workspace import stored


def running_weights(df: DataFrame, keys: list[str], value: str, weight: str, name: str) -> DataFrame:
    """Add ``before`` and ``upto``: the key's weight below each value, and with it; and ``total``.

    ``df`` has one row per key and value. Rows are sorted by range, so that a key with most of the
    rows spreads over many tasks; sums inside a range are carried on by a table with one
    row per (range, key).
    """
    order = [*keys, value]
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    kept = stored(ranged, name)
    inside = Window.partitionBy("__range", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = kept.withColumn("upto", F.sum(weight).over(inside))
    along = Window.partitionBy(*keys).orderBy("__range")
    sums = kept.groupBy("__range", *keys).agg(F.sum(weight).alias("__sum"))
    carried = sums.select(
        "__range",
        *keys,
        (F.sum("__sum").over(along) - F.col("__sum")).alias("__carried"),
        F.sum("__sum").over(Window.partitionBy(*keys)).alias("total"),
    )
    both = join_same(local, carried, ["__range", *keys])
    upto = F.col("upto") + F.col("__carried")
    return both.select(
        *df.columns, (upto - F.col(weight)).alias("before"), upto.alias("upto"), "total"
    )
