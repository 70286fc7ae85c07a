"""Where jobs keep streaming checkpoints and intermediate tables."""

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="opsledger-"))
    return context.getCheckpointDir()


_made: list[str] = []
_own = threading.local()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; it stays until ``drop_intermediates``."""
    path = f"{shared_folder(spark)}/opsledger/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    if getattr(_own, "made", None) is not None:
        _own.made.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_intermediates(spark: SparkSession) -> None:
    """Delete what this process has stored in the shared folder; for the end of a job."""
    while _made:
        _delete(spark, _made.pop())


def dropping_intermediates(store):
    """A ``foreachBatch`` function that deletes its own intermediate tables when the micro-batch ends."""

    def run(batch: DataFrame, batch_id: int) -> None:
        _own.made = []
        try:
            store(batch, batch_id)
        finally:
            for path in _own.made:
                _delete(batch.sparkSession, path)
                if path in _made:
                    _made.remove(path)
            _own.made = None

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later steps then neither repeat the work nor depend on lost executors.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
