"""Container log files and pod metadata."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions.text import matches_whole

# Where containers log, and which pods have no running container.
LOG_GLOB = "/var/log/pods/*/*/*.log"
LOG_PATH = r"/var/log/pods/(?:[^/]*_)?([^/_]+)/([^/]+)/[^/]+\.log$"
STOPPED_PHASES = "Pending|Succeeded|Failed|Completed"

LOG_FIELDS = (
    "time",
    "level",
    "name",
    "message",
    "method",
    "path",
    "status_code",
    "duration_seconds",
    "trace_id",
)


def stream_log_files(spark: SparkSession, glob: str = LOG_GLOB) -> DataFrame:
    """New lines of all matching files, with the file each came from."""
    return spark.readStream.text(glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")
    )


def read_log_files(spark: SparkSession, glob: str = LOG_GLOB) -> DataFrame:
    return spark.read.text(glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")
    )


def with_file_keys(logs: DataFrame, path: str = "path") -> DataFrame:
    """Add ``uid`` and ``container``, taken from the file path."""
    return logs.withColumn("uid", F.regexp_extract(path, LOG_PATH, 1)).withColumn(
        "container", F.regexp_extract(path, LOG_PATH, 2)
    )


def pod_targets(pods: DataFrame) -> DataFrame:
    """Pods with a running container, under log label names, with their log path."""
    return (
        pods.where(~F.coalesce(matches_whole("phase", STOPPED_PHASES), F.lit(False)))
        .select(
            "uid",
            "namespace",
            "pod",
            "container",
            "app",
            F.format_string("/var/log/pods/*%s*/*%s*/*.log", "uid", "container").alias("path_glob"),
        )
    )


def parse_log_json(
    logs: DataFrame, line: str = "line", fields: tuple[str, ...] = LOG_FIELDS
) -> DataFrame:
    """Add ``fields``, the named JSON fields of the line as text; null when not JSON.

    ``json_tuple`` reads all fields in one parse, and filters on them stay behind it.
    ``from_json`` would be repeated for every field and every filter.
    """
    names = [f"__json_{name}" for name in fields]
    parsed = logs.select("*", F.json_tuple(line, *fields).alias(*names))
    return parsed.withColumn(
        "fields", F.struct(*[F.col(n).alias(name) for n, name in zip(names, fields)])
    ).drop(*names)
