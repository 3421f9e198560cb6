"""Spark session settings the library relies on.

The library never creates a session behind the caller's back; ``configure`` only sets the SQL
options whose values change results (UTC session zone) or plans (AQE), and ``local_session`` is a
convenience for tests and the bench.
"""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL options applied to every session the pipeline runs in. Values are strings, as Spark stores them.
SQL_OPTIONS = {
    # Every timestamp in the sources is wall-clock UTC; hour and weekday rules depend on it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "listenscape") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LISTENSCAPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SQL_OPTIONS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder; set a scratch one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is always honoured. A session
    without it uses a folder below its warehouse, which all executors share as well.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    sc.setCheckpointDir(path)
    return path


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that nothing refers to any more; without a collection on the
    driver they stay on the executors' disks for up to half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to a folder of its own in the checkpoint folder, and that folder's path; it goes with the driver's
    JVM. The shuffle files of the plan behind it go when it is written."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path), path


def drop_scratch(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
