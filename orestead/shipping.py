"""Getting this package to the Python workers of a cluster."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package: sends it to the executors. Workers of a local master have the driver's PYTHONPATH."""
    root = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    app = context.applicationId
    local = context.master.startswith("local") and not context.master.startswith("local-cluster")
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app in _shipped or (local and root in paths):
        return
    folder = tempfile.TemporaryDirectory(prefix="orestead-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    target = Path(folder.name) / "orestead-package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(Path(__file__).resolve().parent.rglob("*.py")):
            z.write(f, f.relative_to(root))
    context.addPyFile(str(target))
    _shipped.add(app)
