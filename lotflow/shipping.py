"""Sends the package to the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package once per application as a file that Spark itself copies to every executor.

    Workers then import it by name, so what a module keeps (loaded vocabularies, word caches)
    outlives a task wherever Spark reuses the worker.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return spark
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="lotflow-code-"), "lotflow.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
    return spark
