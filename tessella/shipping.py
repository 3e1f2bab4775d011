"""Makes the package importable for Python workers that do not have it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add this package to the session's Python files, once an application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp()) / f"{here.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(here.rglob("*.py")):
                z.write(p, p.relative_to(here.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)
    return spark
