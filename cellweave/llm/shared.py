"""The shared folder of the cluster: written tables that cut lineage, and files of operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session that names none gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="cellweave-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_root(spark)}/cellweave/{uuid.uuid4().hex}/{name}"
    atexit.register(_remove, spark, path.rpartition("/")[0])
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is gone: the folder's owner cleans up
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that lost executors don't recompute them."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
