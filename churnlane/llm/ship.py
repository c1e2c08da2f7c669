"""Makes this package importable in Python workers that do not share the driver's path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import churnlane

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application (``addPyFile``)."""
    sc = spark.sparkContext
    if sc.applicationId in _done:
        return
    root = os.path.dirname(os.path.abspath(churnlane.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="churnlane-pkg-"), "churnlane_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("churnlane", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _done.add(sc.applicationId)
