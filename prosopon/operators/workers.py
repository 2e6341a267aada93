"""Python workers that can import this package."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent.parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers, once per application, unless PYTHONPATH already leads them to it."""
    app = spark.sparkContext.applicationId
    if str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or app in _shipped:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='prosopon-code-')}/prosopon", "zip", _ROOT, "prosopon")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
