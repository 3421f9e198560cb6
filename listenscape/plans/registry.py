"""Registered queries: each binds the test tables of one scale factor and runs one operator.

Every callable takes (spark, sf_dir) and returns a DataFrame whose column names equal those of
the matching DuckDB statement in ``listenscape.checks.oracle``. Times are epoch seconds.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenscape.operators import channels, facts, labels, matrix, names, reduce, regroup, scaling, slots
from listenscape.plans import config as C
from listenscape.plans import pipeline, state
from listenscape.plans.demo import CHANNEL_LISTEN_TYPES, SIGNED, demo_config
from listenscape.session import ensure_checkpoint_dir
from listenscape.sources import files
from listenscape.sources import testdata
from listenscape.sources.tables import Sources

Query = Callable[[SparkSession, str], DataFrame]


def _src(spark: SparkSession, sf_dir: str) -> Sources:
    return testdata.bind(spark, sf_dir)


def _epoch(name: str) -> F.Column:
    return F.unix_timestamp(F.col(name)).alias(name)


def q_scan_streams(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.scan_streams(s.streams, s.window).select(
        "stream_id", "gigya_id", "listener_id", "stream_name", "platform", "duration",
        _epoch("request_start"), _epoch("request_end"),
    )


def q_scan_on_demand(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.scan_on_demand(s.on_demand, s.window).select("listener_id", "episode_id", "aod_type", "p_listen_date")


def q_valid_ids(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.valid_ids(s.streams, s.window)


def q_consent_filter(spark, sf_dir):
    return facts.consent_filter(_src(spark, sf_dir).consent)


def q_total_duration(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.total_duration(s.streams, s.consent, s.window)


def q_platform_duration(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.platform_duration(s.streams, s.window)


def q_category_freq(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.category_freq(s.on_demand, s.episode_category, s.window)


def q_category_weighted(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.category_weighted(s.streams, s.on_demand, s.episode_category, s.window)


def q_listen_type_freq(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.listen_type_freq(s.on_demand, s.window)


def q_listen_type_weighted(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.listen_type_weighted(s.streams, s.on_demand, s.window)


def q_age_band(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.age_band(s.demographics, s.window)


def q_gender_flag(spark, sf_dir):
    s = _src(spark, sf_dir)
    return facts.gender_flag(s.demographics, s.window)


def q_daypart_usage(spark, sf_dir):
    s = _src(spark, sf_dir)
    cfg = demo_config()
    return facts.daypart_usage(s.streams, C.hour_dayparts(spark, cfg.main_segments()), s.window)


def q_listening_slots(spark, sf_dir):
    s = _src(spark, sf_dir)
    return slots.listening_slots(s.streams, s.window).select(
        "gigya_id", "stream_id", "n", _epoch("slot_start"), _epoch("slot_end"), "slot_seconds"
    )


def q_slot_seconds(spark, sf_dir):
    s = _src(spark, sf_dir)
    return slots.listening_slots(s.streams, s.window).groupBy("stream_id").agg(
        F.count(F.lit(1)).alias("n_slots"), F.sum("slot_seconds").alias("slot_seconds")
    )


def q_schedule_brand(spark, sf_dir):
    s = _src(spark, sf_dir)
    return slots.schedule_brand(s.schedule, s.window).select(
        "show_id", "fqsn", "brand", _epoch("show_start"), _epoch("show_end"), "show_long_name"
    )


def q_slot_brand(spark, sf_dir):
    s = _src(spark, sf_dir)
    return slots.slot_brand(s.streams, s.stream_map, s.window).select(
        "gigya_id", "stream_name", "brand_name", "playlists", _epoch("slot_start"), _epoch("slot_end"), "seconds"
    )


def q_show_match(spark, sf_dir):
    s = _src(spark, sf_dir)
    return slots.show_match(s.streams, s.stream_map, s.schedule, s.window).select(
        "gigya_id", "brand_name", "playlists", _epoch("slot_start"), _epoch("slot_end"), "seconds",
        "show_long_name", "tag",
    )


def q_playlist_duration(spark, sf_dir):
    s = _src(spark, sf_dir)
    return slots.playlist_duration(s.streams, s.stream_map, s.schedule, s.window)


# ---------------------------------------------------------------------------------------------
# Segment features (all main segments of the demo configuration in one plan)

ROUND = 6


def _r(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, ROUND)


def _segs():
    return demo_config().main_segments()


def _nonzero(df: DataFrame) -> DataFrame:
    return df.select("segment", "gigya_id", "feature", _r("value").alias("value")).where(F.col("value") != 0)


def q_category_group(spark, sf_dir):
    s = _src(spark, sf_dir)
    cw = facts.category_weighted(s.streams, s.on_demand, s.episode_category, s.window)
    return regroup.category_group(spark, cw, _segs())


def _summed(df: DataFrame) -> DataFrame:
    return df.groupBy("segment", "gigya_id", "feature").agg(F.sum("value").alias("value"))


def q_regroup_features(spark, sf_dir):
    s = _src(spark, sf_dir)
    block = regroup.category_block(facts.category_weighted(s.streams, s.on_demand, s.episode_category, s.window))
    return _summed(regroup.rewrite(block, regroup.category_rules(spark, block, _segs())))


def _playlist(s):
    return slots.playlist_duration(s.streams, s.stream_map, s.schedule, s.window)


def q_live_playlist_totals(spark, sf_dir):
    s = _src(spark, sf_dir)
    return regroup.live_playlist_totals(spark, _playlist(s), _segs())


def q_residual_rollup(spark, sf_dir):
    s = _src(spark, sf_dir)
    block = regroup.playlist_block(_playlist(s))
    return _summed(regroup.rewrite(block, regroup.playlist_rules(spark, block, _segs())))


def q_new_members(spark, sf_dir):
    s = _src(spark, sf_dir)
    return regroup.new_members(spark, _playlist(s), _segs())


def q_mapping_delta(spark, sf_dir):
    """What two weekly runs append to `Specials`: the second reads the first one's committed state."""
    store = state.StateStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/state-{uuid.uuid4().hex}")
    for run_date in ("2024-01-22", "2024-01-29"):
        cfg = dataclasses.replace(demo_config(), run_date=run_date)
        before = store.before(run_date)
        tables = state.evolve(spark, _playlist(testdata.bind(spark, sf_dir, run_date)), state.with_state(cfg, before), before)
        store.commit(run_date, cfg.version, tables | {"segment_status": before["segment_status"]})
    return store.before("2024-01-30")["mapping_delta"].withColumnRenamed("group", "grp")


def q_master_long(spark, sf_dir):
    return pipeline.master_facts(_src(spark, sf_dir))


def q_platform_fold(spark, sf_dir):
    s = _src(spark, sf_dir)
    block = regroup.platform_block(facts.platform_duration(s.streams, s.window))
    rules = regroup.platform_rules(spark, block, _segs(), demo_config().default_platform)
    return _summed(regroup.rewrite(block, rules))


def q_newsflash_fold(spark, sf_dir):
    s = _src(spark, sf_dir)
    block = regroup.listen_type_block(facts.listen_type_weighted(s.streams, s.on_demand, s.window))
    return _summed(regroup.rewrite(block, regroup.listen_type_rules(block, _segs())))


def q_feature_matrix(spark, sf_dir):
    s = _src(spark, sf_dir)
    asm = matrix.assemble(spark, s, demo_config())
    return _nonzero(matrix.feature_matrix(asm))


def q_drop_top_listener(spark, sf_dir):
    s = _src(spark, sf_dir)
    return matrix.drop_top_listener(facts.total_duration(s.streams, s.consent, s.window))


def q_listen_quantiles(spark, sf_dir):
    s = _src(spark, sf_dir)
    spine = facts.total_duration(s.streams, s.consent, s.window)
    q1, q3 = matrix.listen_quantiles(spine)  # none of a single listener, who is the top one
    upper = None if q1 is None else q3 + 1.5 * (q3 - q1)
    return spark.createDataFrame([(q1, q3, upper)], "q1 double, q3 double, upper double").select(
        _r("q1").alias("q1"), _r("q3").alias("q3"), _r("upper").alias("upper"))


def q_outlier_cut(spark, sf_dir):
    s = _src(spark, sf_dir)
    return matrix.outlier_cut(facts.total_duration(s.streams, s.consent, s.window))


_PREPARED: dict = {}


def _prepared(spark, sf_dir) -> pipeline.RunResult:
    key = (id(spark), sf_dir)
    if key not in _PREPARED:
        _PREPARED.clear()
        _PREPARED[key] = pipeline.prepare(spark, _src(spark, sf_dir), demo_config())
    return _PREPARED[key]


def q_feature_stats(spark, sf_dir):
    st = _prepared(spark, sf_dir).stats
    return st.select("segment", "feature", "n", *[_r(c).alias(c) for c in ("min", "max", "sum", "mean", "stddev")])


def q_scale_strong(spark, sf_dir):
    res = _prepared(spark, sf_dir)
    return _nonzero(scaling.scale_strong(res.cells, res.coefficients, matrix.matrix_rows(res.kept, res.assembly.segments)))


def q_minmax_scale(spark, sf_dir):
    return _nonzero(_prepared(spark, sf_dir).norm)


def q_strong_features(spark, sf_dir):
    res = _prepared(spark, sf_dir)
    return scaling.strong_features(res.assembly.catalog, C.weights(spark, res.assembly.segments))


def q_signal_gate(spark, sf_dir):
    return _prepared(spark, sf_dir).gate.select("segment", "feature", _r("total").alias("total"), "action")


def q_spike_suppress(spark, sf_dir):
    res = _prepared(spark, sf_dir)
    out = scaling.spike_suppress(res.cells, res.stats, C.weights(spark, res.assembly.segments))
    return _nonzero(out)


def q_mean_level(spark, sf_dir):
    res = _prepared(spark, sf_dir)
    out = scaling.mean_level(res.cells, res.stats, C.weights(spark, res.assembly.segments))
    return _nonzero(out)


def _signed(spark, sf_dir):
    """(cells, coefficients, matrix rows) of the prepared run with some columns negated."""
    res = _prepared(spark, sf_dir)
    value = F.when(F.col("feature").isin(*SIGNED), -F.col("value")).otherwise(F.col("value"))
    cells = res.cells.withColumn("value", value)
    stats = matrix.feature_stats(cells, res.assembly.catalog, res.n_kept)
    coef = pipeline.settled(scaling.coefficients(stats, C.weights(spark, res.assembly.segments)))
    return cells, coef, matrix.matrix_rows(res.kept, res.assembly.segments)


def q_signed_scale_strong(spark, sf_dir):
    return _nonzero(scaling.scale_strong(*_signed(spark, sf_dir)))


def q_signed_minmax_scale(spark, sf_dir):
    return _nonzero(scaling.minmax_scale(*_signed(spark, sf_dir)))


def _weak(spark, sf_dir):
    """(columns, sparse rows, normalised cells, split, n) of the segments that pass, over the signed cells."""
    res = _prepared(spark, sf_dir)
    cells, coef, rows = _signed(spark, sf_dir)
    norm = pipeline.settled(scaling.minmax_scale(cells, coef, rows))
    columns, sparse = pipeline.weak_rows(res.split, coef, rows, norm)
    return columns, sparse, norm, res.split, res.n_kept


def q_weak_gram(spark, sf_dir):
    """Mean products of the weak columns of each passing segment, upper triangle."""
    columns, rows, _, _, n = _weak(spark, sf_dir)
    return reduce.mean_products(rows, columns, n).select("segment", "feature_a", "feature_b", _r("value").alias("value"))


def _given_basis(columns):
    """Three fixed vectors for segment A, by the place of a column; none for the others."""
    load = (F.pmod(F.col("idx") * 7 + F.col("component") * 3, F.lit(11)) - 5) / 8.0
    each = columns.where("segment = 'A'").withColumn("component", F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)]))).withColumn("load", load)
    return each.groupBy("segment", "component").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "load"))), lambda x: x["load"]).alias("loadings"),
        F.sum(F.col("load") * F.col("zero")).alias("base")).withColumn("chosen", F.lit(True))


def q_component_scores(spark, sf_dir):
    """Scores on a given basis, scaled to 0..100."""
    columns, rows, *_ = _weak(spark, sf_dir)
    return reduce.project(rows, _given_basis(columns)).select("segment", "gigya_id", "component", _r("value").alias("value"))


def q_segment_matrix_given(spark, sf_dir):
    """Model input on a given basis: A is reduced, D keeps its weak columns."""
    columns, rows, norm, split, _ = _weak(spark, sf_dir)
    basis = _given_basis(columns)
    return _nonzero(reduce.model_input(reduce.project(rows, basis), norm, split, basis))


def q_reduced_components(spark, sf_dir):
    """Variance ratios of the components. Components of equal ratio may change places, so none but these are shown."""
    res = _prepared(spark, sf_dir)
    columns, rows = pipeline.weak_rows(res.split, res.coefficients, matrix.matrix_rows(res.kept, res.assembly.segments), res.norm)
    return reduce.fit_bases(rows, columns, res.n_kept).select("segment", "component", _r("ratio").alias("ratio"), _r("cumulative").alias("cumulative"), "chosen")


def q_segment_matrix(spark, sf_dir):
    res = pipeline.reduce_segments(spark, _prepared(spark, sf_dir))
    return res.model_input.select("segment", "gigya_id", "feature", _r("value").alias("value"))


# Wide pivots (A10, A11) with value lists from the configuration


def _segment_a(block_rules: DataFrame) -> DataFrame:
    return block_rules.where(F.col("segment") == "A").drop("segment")


def _stage_values(stage: str) -> list[str]:
    """The names that the templates of the main segments list in a stage."""
    return list(dict.fromkeys(v for seg in _segs() for v in seg.template[stage]))


def q_category_pivot(spark, sf_dir):
    return matrix.pivot_all(q_regroup_features(spark, sf_dir), _stage_values("stage_1"))


def q_playlist_pivot(spark, sf_dir):
    return matrix.pivot_all(q_residual_rollup(spark, sf_dir), _stage_values("stage_2"))


def q_platform_pivot(spark, sf_dir):
    cfg = demo_config()
    seg = cfg.main_segments()[0]
    cells = _segment_a(q_platform_fold(spark, sf_dir))
    return matrix.pivot(cells, seg.template["stage_5"], "sum")


def q_listen_type_pivot(spark, sf_dir):
    s = _src(spark, sf_dir)
    block = regroup.listen_type_block(facts.listen_type_weighted(s.streams, s.on_demand, s.window))
    return matrix.pivot(block.withColumnRenamed("member", "feature"), ["catchup", "podcast", "newsflash"], "sum")


def q_daypart_pivot(spark, sf_dir):
    seg = demo_config().main_segments()[0]
    dp = q_daypart_usage(spark, sf_dir).where(F.col("segment") == "A").select(
        "gigya_id", F.col("key").alias("feature"), F.col("listen_number_time").cast("double").alias("value"))
    return matrix.pivot(dp, seg.template["stage_6"], "sum")


AGE_BANDS = ["15-19", "20-24", "25-34", "35-44", "45-54", "55-59", "60+"]


def q_age_pivot(spark, sf_dir):
    s = _src(spark, sf_dir)
    block = regroup.flag_block(facts.age_band(s.demographics, s.window), "age_band")
    return matrix.pivot(block.withColumnRenamed("member", "feature"), AGE_BANDS, "max")


def q_gender_pivot(spark, sf_dir):
    s = _src(spark, sf_dir)
    block = regroup.flag_block(facts.gender_flag(s.demographics, s.window), "gender")
    return matrix.pivot(block.withColumnRenamed("member", "feature"), ["f", "m"], "max")


def q_drop_junk_columns(spark, sf_dir):
    """Gender presence pivoted with the unknown value kept, then the junk columns dropped."""
    s = _src(spark, sf_dir)
    g = facts.gender_flag(s.demographics, s.window).select(
        "gigya_id", F.col("gender").alias("feature"), F.col("gender_bool").cast("double").alias("value"))
    return names.drop_junk_columns(matrix.pivot(g, ["f", "m", "u"], "max"))


def q_clean_column_names(spark, sf_dir):
    """Listen-type pivot named the way a warehouse PIVOT names columns ('value'), then cleaned."""
    s = _src(spark, sf_dir)
    block = regroup.listen_type_block(facts.listen_type_weighted(s.streams, s.on_demand, s.window))
    quoted = block.select("gigya_id", F.concat(F.lit("'"), F.col("member"), F.lit("'")).alias("feature"), "value")
    wide = matrix.pivot(quoted, ["'catchup'", "'podcast'", "'newsflash'"], "sum")
    return names.clean_column_names(wide)


def q_cluster_label(spark, sf_dir):
    return labels.cluster_label(testdata.predictions(spark, sf_dir), ["Cluster 1", "Cluster 3"])


def q_csv_roundtrip(spark, sf_dir):
    s = _src(spark, sf_dir)
    total = facts.total_duration(s.streams, s.consent, s.window)
    return files.csv_roundtrip(spark, total, "total_duration")


def q_channel_duration(spark, sf_dir):
    s = _src(spark, sf_dir)
    return channels.channel_duration(s.streams, s.stream_map, s.window)


def q_channel_listen_type(spark, sf_dir):
    s = _src(spark, sf_dir)
    return channels.channel_listen_type(s.streams, s.on_demand, s.extra["channels"], s.window, CHANNEL_LISTEN_TYPES)


def q_channel_playlist(spark, sf_dir):
    s = _src(spark, sf_dir)
    return channels.channel_playlist(spark, regroup.playlist_block(_playlist(s)), _segs())


QUERIES: dict[str, Query] = {
    "scan_streams": q_scan_streams,
    "scan_on_demand": q_scan_on_demand,
    "valid_ids": q_valid_ids,
    "consent_filter": q_consent_filter,
    "total_duration": q_total_duration,
    "platform_duration": q_platform_duration,
    "category_freq": q_category_freq,
    "category_weighted": q_category_weighted,
    "listen_type_freq": q_listen_type_freq,
    "listen_type_weighted": q_listen_type_weighted,
    "age_band": q_age_band,
    "gender_flag": q_gender_flag,
    "daypart_usage": q_daypart_usage,
    "listening_slots": q_listening_slots,
    "slot_seconds": q_slot_seconds,
    "schedule_brand": q_schedule_brand,
    "slot_brand": q_slot_brand,
    "show_match": q_show_match,
    "playlist_duration": q_playlist_duration,
    "category_group": q_category_group,
    "regroup_features": q_regroup_features,
    "live_playlist_totals": q_live_playlist_totals,
    "residual_rollup": q_residual_rollup,
    "new_members": q_new_members,
    "mapping_delta": q_mapping_delta,
    "master_long": q_master_long,
    "platform_fold": q_platform_fold,
    "newsflash_fold": q_newsflash_fold,
    "feature_matrix": q_feature_matrix,
    "drop_top_listener": q_drop_top_listener,
    "listen_quantiles": q_listen_quantiles,
    "outlier_cut": q_outlier_cut,
    "feature_stats": q_feature_stats,
    "scale_strong": q_scale_strong,
    "minmax_scale": q_minmax_scale,
    "strong_features": q_strong_features,
    "signal_gate": q_signal_gate,
    "spike_suppress": q_spike_suppress,
    "mean_level": q_mean_level,
    "category_pivot": q_category_pivot,
    "playlist_pivot": q_playlist_pivot,
    "platform_pivot": q_platform_pivot,
    "listen_type_pivot": q_listen_type_pivot,
    "daypart_pivot": q_daypart_pivot,
    "age_pivot": q_age_pivot,
    "gender_pivot": q_gender_pivot,
    "drop_junk_columns": q_drop_junk_columns,
    "clean_column_names": q_clean_column_names,
    "cluster_label": q_cluster_label,
    "csv_roundtrip": q_csv_roundtrip,
    "signed_scale_strong": q_signed_scale_strong,
    "signed_minmax_scale": q_signed_minmax_scale,
    "weak_gram": q_weak_gram,
    "component_scores": q_component_scores,
    "segment_matrix_given": q_segment_matrix_given,
    "reduced_components": q_reduced_components,
    "segment_matrix": q_segment_matrix,
    "channel_duration": q_channel_duration,
    "channel_listen_type": q_channel_listen_type,
    "channel_playlist": q_channel_playlist,
}
