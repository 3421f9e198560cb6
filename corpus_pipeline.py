"""The training-data pipeline: quality, line dedup, near dedup, decontamination, sampled segmentations.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet in the shared
scratch folder and reads back for the next. All stages but the last return the columns of ``documents``;
extra columns are dropped. A stage's own rules for nulls, empty texts and ties are in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listenscape.llm import common, decontaminate, line_dedup, minhash, quality, sample_pieces


def _stage(fn):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return fn(common.configure(spark), docs, sf_dir)

    run_stage.__doc__ = fn.__doc__
    return run_stage


STAGES = [
    ("quality", _stage(quality.pipeline_stage)),
    ("line_dedup", _stage(line_dedup.pipeline_stage)),
    ("near_dedup", _stage(minhash.pipeline_stage)),
    ("decontaminate", _stage(decontaminate.pipeline_stage)),
    ("sample_pieces", _stage(sample_pieces.pipeline_stage)),
]

#: Learned models, similarity joins and seeded sampling have no SQL form; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = common.stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
