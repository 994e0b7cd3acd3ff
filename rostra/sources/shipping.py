"""This package on the executors, for sessions that were started without it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per session; functions that run there import it."""
    context = spark.sparkContext
    if getattr(context, "_rostra_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="rostra-")) / "rostra.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._rostra_shipped = True
