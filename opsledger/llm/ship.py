"""Make this package importable in the Python workers of a session."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, as ``--py-files`` does."""
    context = spark.sparkContext
    if getattr(context, "_opsledger_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="opsledger-code-")) / "opsledger.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    context._opsledger_shipped = True
