"""Hands this package to the Python workers of a session whose machines haven't installed it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Add the package's modules to the session, so that workers on all executors can import them.

    Spark's driver serves the archive to executors, also to those that join later. Not needed where the package is installed or on PYTHONPATH.
    """
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-loomwright-"), "loomwright.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    archive.write(whole, os.path.relpath(whole, os.path.dirname(here)))
    spark.sparkContext.addPyFile(path)
