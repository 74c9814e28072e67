"""Hand the package to the executors of a session that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's modules, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(root)
    # Spark copies the archive to its own file server; executors fetch it from there.
    archive = os.path.join(tempfile.mkdtemp(prefix="tickflow-"), "tickflow.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, base))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
