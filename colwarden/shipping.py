"""Makes this package importable in Python workers, wherever the driver found it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_folders: list[tempfile.TemporaryDirectory] = []

#: Rows of an Arrow batch, where the session has Spark's default: rows may hold long texts or whole archives.
BATCH_ROWS = 1_000
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once for each application, and keep Arrow batches small."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH, _DEFAULT) == _DEFAULT:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if context.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    folder = tempfile.TemporaryDirectory(prefix="colwarden-")
    _folders.append(folder)  # it goes when the driver ends
    target = Path(folder.name) / "colwarden_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, p.relative_to(home.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
