"""Scheduled reports from a kept table of counts: only partitions that have changed are read again.

The table holds, for each partition of the stored orders, its counts per schedule step and a mark of the
files they were counted from (names, sizes, times). A refresh lists the files, counts the
partitions whose mark is another one, and replaces their part of the table. Counts and mark of a
partition are written together, so a refresh that fails half way is finished by the next.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions.timegrid import BUCKET, with_bucket
from opsledger.model import CREATED_DATE, STATUSES
from opsledger.operators.orders import DAY_S, REPORT_PERIOD_DAYS, status_counts, summary_of_steps

ANCHOR_S = 6 * 3600


def _marks(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """One mark per partition that holds files; contents are not read."""
    files = spark.read.format("binaryFile").load(path).where(F.col(partition).isNotNull())
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return files.groupBy(F.col(partition).cast("string").alias(partition)).agg(
        F.concat_ws(":", F.count("*").cast("string"), F.sum(one).cast("string")).alias("mark")
    )


def _kept(spark: SparkSession, table: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.option("basePath", table).parquet(table)


def refresh_counts(
    spark: SparkSession,
    orders: DataFrame,
    path: str,
    table: str,
    every_s: int = DAY_S,
    anchor_s: int = ANCHOR_S,
    partition: str = CREATED_DATE,
) -> list[str]:
    """Bring the counts in ``table`` up to date; returns the partitions that were counted.

    ``orders`` reads the files under ``path``, with their ``partition`` column. A table belongs to one
    schedule: for another ``every_s`` or ``anchor_s`` keep another table.
    """
    now, kept = _marks(spark, path, partition), _kept(spark, table)
    if kept is None:
        changed = [r[partition] for r in now.select(partition).collect()]
        gone = []
    else:
        known = kept.where(F.col(BUCKET).isNull() & F.col("mark").isNotNull()).select(
            F.col(partition).cast("string").alias(partition), F.col("mark").alias("old")
        )
        both = now.join(known, partition, "full").where(~F.col("mark").eqNullSafe(F.col("old"))).collect()
        changed = [r[partition] for r in both if r["mark"] is not None]
        gone = [r[partition] for r in both if r["mark"] is None]
    if not changed and not gone:
        return []
    # a literal list, so that other folders are not even listed
    kind = orders.schema[partition].dataType
    rows = orders.where(F.col(partition).isin([F.lit(c).cast(kind) for c in changed]) if changed else F.lit(False))
    counts = (
        with_bucket(rows, "created_at", every_s, anchor_s)
        .where(F.col(BUCKET).isNotNull())
        .groupBy(F.col(partition).cast("string").alias(partition), BUCKET)
        .agg(*status_counts())
        .withColumn("mark", F.lit(None).cast("string"))
    )
    # files that come while this runs change the mark of the next listing, and are counted then
    marks = now.where(F.col(partition).isin(changed)) if changed else now.limit(0)
    empty = spark.createDataFrame([(g, None) for g in gone], f"{partition} string, mark string")
    lines = marks.unionByName(empty)
    missing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in counts.schema}
    marked = lines.select(*[F.col(c) if c in lines.columns else missing[c] for c in counts.columns])
    counts.unionByName(marked).hint("rebalance", partition).write.partitionBy(partition).option(
        "partitionOverwriteMode", "dynamic"
    ).mode("overwrite").parquet(table)
    return sorted(changed)


def kept_summary(
    spark: SparkSession,
    table: str,
    period_s: int = REPORT_PERIOD_DAYS * DAY_S,
    every_s: int = DAY_S,
    anchor_s: int = ANCHOR_S,
) -> DataFrame:
    """What ``sliding_summary`` gives for the orders, from the kept counts."""
    kept = _kept(spark, table)
    if kept is None:
        raise FileNotFoundError(f"no counts are kept at {table}")
    names = ["total_orders", *STATUSES]
    steps = kept.where(F.col(BUCKET).isNotNull()).groupBy(BUCKET).agg(*[F.sum(n).alias(n) for n in names])
    return summary_of_steps(steps, period_s, every_s, anchor_s)

