"""Cluster labelling of a scored output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

APPROVAL_COLUMN = "DEPLOYMENT_APPROVAL_STATUS"


def cluster_label(scored: DataFrame, clusters: list[str], prediction: str = "PREDICTION") -> DataFrame:
    """Drop the approval column and the per-cluster probability columns (`Cluster <i>_PREDICTION`
    for i up to the number of distinct predictions), and add `Label` = 1 when the prediction is
    one of ``clusters``.

    The number of clusters is one small aggregate; the labelling itself is a column expression."""
    k = scored.agg(F.countDistinct(prediction).alias("k")).collect()[0]["k"]
    drop = [APPROVAL_COLUMN] + [f"Cluster {i + 1}_PREDICTION" for i in range(k)]
    out = scored.drop(*[c for c in drop if c in scored.columns])
    return out.withColumn("Label", F.when(F.col(prediction).isin(*clusters), F.lit(1)).otherwise(F.lit(0)))
