"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE does the run-time work every plan here relies on: coalescing small shuffle
# partitions, turning joins into broadcasts once a side's real size is known, and
# splitting skewed join partitions (also where that costs one more shuffle).
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(app_name: str = "placewise") -> SparkSession.Builder:
    """A session builder with the SQL settings the jobs are designed for."""
    b = SparkSession.builder.appName(app_name)
    for key, value in SQL_CONF.items():
        b = b.config(key, value)
    return b


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder. On a cluster
    the setting is required, since a machine-local folder dies with its machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="placewise-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other job uses, in the folder of this application."""
    return f"{shared_dir(spark)}/placewise/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession, application: str | None = None) -> bool:
    """Removes what an application (by default this one) has written to scratch paths; whether there was any.

    For the end of a run: DataFrames that were made from scratch tables cannot be read any more.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/placewise/{application or spark.sparkContext.applicationId}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Has Spark remove the shuffle files and stored blocks that nothing refers to any more.

    Spark learns of them when the driver collects its garbage, which a driver with little to do puts off for long. For
    the end of a large step, once what it made is written.
    """
    gc.collect()
    spark._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions for rows that are few in bytes but costly in work.

    AQE sizes partitions by bytes, so it would put such rows into one task; an explicit
    repartition to this number keeps them spread.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
