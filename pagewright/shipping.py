"""Sending this package to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that workers can import it wherever the
    driver runs."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="pagewright-")) / "pagewright.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in root.rglob("*.py"):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)
