"""The package's code for Python workers that do not see the driver's folders."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import tierwork


def ship(spark: SparkSession) -> None:
    """Give the workers of this Spark application the package, once: Spark carries the archive to every executor."""
    context = spark.sparkContext
    if getattr(context, "_tierwork_shipped", False):
        return
    root = Path(tierwork.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tierwork-code-")) / "tierwork.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"tierwork/{f.relative_to(root)}")
    context.addPyFile(str(archive))
    context._tierwork_shipped = True
