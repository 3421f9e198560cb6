"""The weekly run for all main segments at once.

    sources ──► long facts ──► per-segment cells (one union, one aggregate)
            ──► spine outlier cut (once, shared by all segments)
            ──► statistics ──► strong scaling + min-max (affine per column, broadcast)
            ──► signal gate ──► weak / strong split ──► SVD of the weak part ──► model input

Materialisation points: the kept listeners' cells are checkpointed (reliable checkpoint in the
cluster's ``spark.checkpoint.dir``), because statistics, scaling, the gate and the dense rows all
read them; an executor lost after that point costs only the stages after it. The driver receives
one-row statistics (quantiles, row count) and the chosen vectors of each segment (at most 50 per segment).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenscape.operators import facts, matrix, reduce, scaling, slots
from listenscape.plans import config as C
from listenscape.session import ensure_checkpoint_dir, free_shuffles
from listenscape.sources.tables import Sources


@dataclass
class RunResult:
    assembly: matrix.Assembly
    kept: DataFrame              # (gigya_id, total_listen_time) after the outlier cut
    n_kept: int
    cells: DataFrame             # kept listeners' raw cells
    stats: DataFrame
    coefficients: DataFrame
    norm: DataFrame              # normalised cells (analytics output)
    gate: DataFrame
    split: DataFrame             # (segment, feature, strong) of segments that pass the gate
    bases: DataFrame | None = None   # components of each segment's chosen rung, see reduce.BASIS
    components: DataFrame | None = None
    model_input: DataFrame | None = None


def settled(df: DataFrame, checkpoint: bool = True) -> DataFrame:
    """``df`` in a reliable checkpoint: several plans read it, and none of them carries the plan behind it."""
    if not checkpoint:
        return df.cache()
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def prepare(spark: SparkSession, src: Sources, cfg: C.RunConfig, checkpoint: bool = True, learned: DataFrame | None = None) -> RunResult:
    asm = matrix.assemble(spark, src, cfg, learned)
    if checkpoint:
        # One materialisation of all facts: everything after it reads the checkpoint files.
        asm.cells_all = settled(asm.cells_all)
        asm.spine = settled(asm.spine)
        asm.release()
        free_shuffles(spark)
    catalog = settled(asm.catalog, checkpoint)
    kept = settled(matrix.outlier_cut(asm.spine), checkpoint)
    n_kept = kept.count()
    cells = matrix.feature_matrix(asm, kept).cache()
    weights = C.weights(spark, asm.segments).cache()
    stats = settled(matrix.feature_stats(cells, catalog, n_kept), checkpoint)
    coef = settled(scaling.coefficients(stats, weights), checkpoint)
    norm = settled(scaling.minmax_scale(cells, coef, matrix.matrix_rows(kept, asm.segments)), checkpoint)
    gate = settled(scaling.signal_gate(coef, norm, weights), checkpoint)
    split = settled(scaling.strong_features(catalog, weights).join(
        scaling.skipped_segments(gate), "segment", "left_anti"), checkpoint)
    free_shuffles(spark)
    return RunResult(asm, kept, n_kept, cells, stats, coef, norm, gate, split)


def weak_rows(split: DataFrame, coef: DataFrame, rows: DataFrame, norm: DataFrame, checkpoint: bool = True) -> tuple[DataFrame, DataFrame]:
    """(columns, sparse rows) of the weak matrices of the segments that pass the gate, see ``reduce``; the Gram pass and
    the projection read them."""
    columns = settled(reduce.weak_columns(split, scaling.zero_images(coef)), checkpoint)
    sparse = settled(reduce.sparse_rows(rows, norm, columns), checkpoint)
    free_shuffles(split.sparkSession)
    return columns, sparse


def reduce_segments(spark: SparkSession, res: RunResult, checkpoint: bool = True) -> RunResult:
    """SVD of every passing segment's weak columns and the model-input cells."""
    columns, rows = weak_rows(res.split, res.coefficients, matrix.matrix_rows(res.kept, res.assembly.segments), res.norm, checkpoint)
    res.bases = settled(reduce.choose_bases(rows, columns, res.n_kept), checkpoint)
    res.components = reduce.project(rows, res.bases)
    res.model_input = reduce.model_input(res.components, res.norm, res.split, res.bases)
    return res


def run(spark: SparkSession, src: Sources, cfg: C.RunConfig, checkpoint: bool = True, learned: DataFrame | None = None) -> RunResult:
    return reduce_segments(spark, prepare(spark, src, cfg, checkpoint, learned), checkpoint)


def _write(df: DataFrame, path: str, *parts: str) -> None:
    """Replace only the partitions that ``df`` holds, so a run keeps the weeks before it and may be repeated."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def write_outputs(res: RunResult, base_path: str, run_date: str, version: str) -> None:
    """Model input and analytics matrices partitioned by segment and run date; the gate status
    and the kept listeners (the rows of every matrix) alongside. Failures raise (they are not turned into a status string)."""
    tag = {"run_date": run_date, "version": version}

    def stamp(df: DataFrame) -> DataFrame:
        for k, v in tag.items():
            df = df.withColumn(k, F.lit(v))
        return df

    _write(stamp(res.model_input), f"{base_path}/model_input", "segment", "run_date", "version")
    _write(stamp(res.norm), f"{base_path}/analytics", "segment", "run_date", "version")
    _write(stamp(res.gate), f"{base_path}/segment_status", "run_date", "version")
    _write(stamp(res.kept), f"{base_path}/listeners", "run_date", "version")


def master_facts(src: Sources) -> DataFrame:
    """(fact, gigya_id, key, value): the seven weekly facts as one table, every row of them: unknown keys (NULL, `u`) and
    listeners without plays (NULL value) included. The facts on streams share one rollup of the log, which is
    persisted; only the slots read the log itself."""
    w = src.window
    roll = facts.stream_rollup(src.streams, w).persist()
    long = {
        "total_duration": facts.total_duration(src.streams, src.consent, w, roll).select("gigya_id", F.lit(None).cast("string"), "total_listen_time"),
        "podcast_duration": facts.category_weighted(src.streams, src.on_demand, src.episode_category, w, roll),
        "playlist_duration": slots.playlist_duration(src.streams, src.stream_map, src.schedule, w),
        "listentype_duration": facts.listen_type_weighted(src.streams, src.on_demand, w, roll),
        "platform_duration": facts.platform_duration(src.streams, w, roll),
        "age_duration": facts.age_band(src.demographics, w),
        "gender_duration": facts.gender_flag(src.demographics, w),
    }
    out = None
    for name, df in long.items():
        part = df.toDF("gigya_id", "key", "value").select(F.lit(name).alias("fact"), "gigya_id", "key", F.col("value").cast("double").alias("value"))
        out = part if out is None else out.unionAll(part)
    return out


def write_master_facts(spark: SparkSession, src: Sources, base_path: str, run_date: str, version: str,
                       segments: list[C.SegmentConfig]) -> None:
    """``master_facts`` partitioned by run date, version and fact."""
    out = master_facts(src).withColumn("run_date", F.lit(run_date)).withColumn("version", F.lit(version))
    _write(out, f"{base_path}/master_facts", "run_date", "version", "fact")
