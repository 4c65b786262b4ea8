"""Tables in the shared folder that a session names: they cut lineage and outlive lost executors."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def own_folder() -> str:
    """For sessions on one machine without spark.checkpoint.dir, such as tests. Removed when Python ends."""
    root = tempfile.mkdtemp(prefix="spark-loomwright-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_dir(spark: SparkSession) -> str:
    """A new folder's path under the shared folder in spark.checkpoint.dir, which must be set on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = own_folder()
    return f"{root.rstrip('/')}/loomwright-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Write df to the shared folder as Parquet and read it again."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders; those that are gone don't matter."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
