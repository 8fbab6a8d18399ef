"""Tables written to the folder that the session names, which cut lineage."""

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


def saved(df: DataFrame) -> DataFrame:
    """The rows written as Parquet and read back; the table goes when the driver's Python ends."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/cellweave/{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is gone: the folder's owner cleans up
        pass
