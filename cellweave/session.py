"""Session settings shared by the bench, the tests and the command line."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str = "cellweave", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session; on a cluster, spark-submit supplies these settings instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def executor_gib(spark: SparkSession) -> float:
    """The memory of an executor's heap in GiB, from the session's settings."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.executor.memory", "1g")) / float(1 << 30)
