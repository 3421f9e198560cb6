"""Shared helpers: reading tables, staging intermediate tables, per-worker caches, links to components."""

from __future__ import annotations

import gc
import re
import sys
import uuid

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Rows per Arrow batch handed to Python workers. Texts can be long, so batches stay small.
ARROW_ROWS = "512"


def configure(spark: SparkSession) -> SparkSession:
    """Session options that the operators rely on; none of them changes a result."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where unset, one below the warehouse."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared scratch folder, deleted when the driver's JVM ends."""
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back: short lineage that
    survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_end_with_query(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_end_with_query(spark: SparkSession):
    """A query's shuffle files go when it ends, not with the driver's garbage. For writes, which run once: a plan
    that is run again makes them anew."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that nothing refers to any more; without a
    collection on the driver they stay on the executors' disks for up to half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_stage(df: DataFrame) -> None:
    """Delete the files behind a staged table that nothing will read again."""
    spark = df.sparkSession
    for f in {re.sub(r"/[^/]*$", "", x) for x in df.inputFiles()}:
        if f.startswith(("file:", "hdfs:", "s3", "viewfs:", "abfs", "gs:")) and scratch_root(spark).split(":")[-1].lstrip("/") in f:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a DataFrame; for a file scan, the size of the files."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(size, 1 << 50)


def shard_count(df: DataFrame, shard_bytes: int) -> int:
    """Shards of about ``shard_bytes`` each, and never fewer than two per shuffle partition, so
    that hashing the shard numbers still fills every partition."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * parts, -(-input_bytes(df) // shard_bytes))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Larger Arrow batches while narrow rows (numbers, short strings) go through Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` staged in ranges of ``order``, with ``_id``: 2^33 times the number of the range plus the place in
    it. Ranges follow sampled quantiles of the whole order, so that a hot leading key is cut into many."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                 .withColumn("_id", F.monotonically_increasing_id()), name)


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``df`` with ``rank``, from 1 within ``keys`` (never null) by ``order``. A group of any size is ranked: it is
    cut into ranges, and a row's rank is the size of the group's earlier ranges plus its place in its own. The
    window below sees a row per range."""
    rows = in_order(df, [F.col(k) for k in keys] + order, name).withColumn("_range", F.shiftright("_id", 33))
    ranges = rows.groupBy(*keys, "_range").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range")
    ranges = ranges.withColumn("_base", F.sum("_n").over(before) - F.col("_n")).drop("_n")
    return (rows.join(ranges, [*keys, "_range"]).withColumn("rank", F.col("_base") + F.col("_id") - F.col("_first") + 1)
            .drop("_id", "_range", "_first", "_base"))


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker (models and vocabularies are built once)."""
    if not hasattr(sys, "_listenscape_worker"):
        sys._listenscape_worker = {}
    return sys._listenscape_worker


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): (id, component = smallest id reachable).

    Alternating large-star / small-star rounds. Each round is one aggregation and one join on the
    edge ends; only an edge count and a checksum reach the driver. The edge list shrinks to one
    star per component. Ids without an edge are not in the result; an empty input gives none.
    """
    e = edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v").distinct()
    e = stage(e, "edges")
    last = None
    for _ in range(max_rounds):
        # Large star: neighbours above a node go to the node's smallest neighbour (or itself).
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        # Small star: a node and its lower neighbours go to the smallest of them.
        low2 = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low2, "v")
        nxt = stage(
            small.select(F.col("m").alias("u"), F.col("u").alias("v")).unionAll(small.select(F.col("m").alias("u"), "v"))
            .where("u < v").distinct(), "edges")
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_stage(e)
        e = nxt
        if tuple(now) == last:
            break
        last = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("v").alias("id"), F.col("u").alias("component")).unionAll(
        e.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct())
