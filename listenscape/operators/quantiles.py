"""Exact quantiles (linear interpolation between order statistics) without a single-task buffer.

Spark's exact ``percentile`` keeps every distinct value of the column in one aggregation buffer
that a single task merges; a skewed or large column makes that task the bottleneck. Here the
column is first reduced to (value, count) - a hot value becomes one row - and the distinct values
are cut into ``buckets`` ranges at approximate quantiles. Inside each range a window gives the
cumulative count, a small per-range table gives the offsets, and the two order statistics around
each requested position are picked with one distributed aggregate. The result equals pandas'
``Series.quantile`` (linear method). A column without values has None for every quantile.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 256


def exact_quantiles(df: DataFrame, column: str, probs: list[float], buckets: int = DEFAULT_BUCKETS) -> list[float | None]:
    vc = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    vc = vc.cache()
    try:
        cuts = vc.approxQuantile("v", [i / buckets for i in range(1, buckets)], 1.0 / (4 * buckets))
        if not cuts:  # no value at all
            return [None] * len(probs)
        splits = [float("-inf")] + sorted(set(cuts)) + [float("inf")]
        b = Bucketizer(splits=splits, inputCol="v", outputCol="bucket").transform(vc)
        per_bucket = b.groupBy("bucket").agg(F.sum("cnt").alias("bucket_cnt"))
        ordered = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        # one row per bucket: a global window over at most `buckets` rows
        offsets = per_bucket.select(
            "bucket",
            F.coalesce(F.sum("bucket_cnt").over(ordered), F.lit(0)).alias("offset"),
            F.sum("bucket_cnt").over(Window.partitionBy()).alias("n"),
        )
        within = Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        ranked = b.withColumn("cum", F.sum("cnt").over(within)).join(F.broadcast(offsets), "bucket")
        first = F.col("offset") + F.col("cum") - F.col("cnt")
        last = F.col("offset") + F.col("cum") - 1
        aggs = []
        for i, p in enumerate(probs):
            pos = F.lit(float(p)) * (F.col("n") - 1)
            lo = F.floor(pos)
            hi = F.least(lo + 1, F.col("n") - 1)
            aggs += [
                F.max(F.when((first <= lo) & (lo <= last), F.col("v"))).alias(f"lo{i}"),
                F.max(F.when((first <= hi) & (hi <= last), F.col("v"))).alias(f"hi{i}"),
                F.max(pos - lo).alias(f"frac{i}"),
            ]
        row = ranked.agg(*aggs).collect()[0]
    finally:
        vc.unpersist()
    out = []
    for i in range(len(probs)):
        lo, hi, frac = row[f"lo{i}"], row[f"hi{i}"], row[f"frac{i}"]
        out.append(None if lo is None else lo + (hi - lo) * frac)
    return out
