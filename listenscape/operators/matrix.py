"""Assembly of the per-segment feature matrices in long form, the outlier cut and statistics.

The matrix of a segment has one row per spine listener (consenting, with streams in the window)
and one column per feature in the segment's catalog; it is kept sparse as
`(segment, gigya_id, feature, value)` cells, with absent cells meaning 0. The catalog - the
columns the wide frame would have - comes from the facts of *all* listeners (a feature seen only
for listeners outside the spine still is a column, of zeros) plus the columns a segment has by
configuration.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenscape.operators import facts, regroup, slots
from listenscape.operators.quantiles import exact_quantiles
from listenscape.plans import config as C
from listenscape.sources.tables import Sources

TOTAL = "total_listen_time"


@dataclass
class Assembly:
    spine: DataFrame        # (gigya_id, total_listen_time)
    cells_all: DataFrame    # (segment, gigya_id, feature, value) for every listener with facts
    structural: DataFrame   # (segment, feature) columns that exist by configuration
    segments: list[C.SegmentConfig]
    persisted: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Drop the persisted intermediate aggregates (after the cells are checkpointed)."""
        for df in self.persisted:
            df.unpersist()
        self.persisted = []

    @property
    def catalog(self) -> DataFrame:
        """(segment, feature): the columns of each segment's matrix."""
        return self.cells_all.select("segment", "feature").unionByName(self.structural).distinct()


def assemble(spark: SparkSession, src: Sources, cfg: C.RunConfig, learned: DataFrame | None = None) -> Assembly:
    """``learned``: members that earlier runs appended to playlist groups, see ``regroup.member_groups``."""
    segs = cfg.main_segments()
    w = src.window
    # The stream log is read twice in the whole plan: once for all per-listener aggregates (one
    # GROUPING SETS pass shared by the spine, platform, fan-out and daypart facts) and once for the
    # ten-minute slots, which need every stream row.
    # Each per-listener aggregate is read by several consumers (the block itself and its rule
    # vocabulary; the rollup by five facts) whose pushed-down filters differ, so exchange reuse
    # cannot share them: they are persisted. All are aggregates per listener (x key), orders of
    # magnitude smaller than the logs; a lost executor recomputes its partitions from lineage.
    roll = facts.stream_rollup(src.streams, w).persist()
    spine = facts.total_duration(src.streams, src.consent, w, roll)

    cat = regroup.category_block(
        facts.category_weighted(src.streams, src.on_demand, src.episode_category, w, roll)).persist()
    pl = regroup.playlist_block(slots.playlist_duration(src.streams, src.stream_map, src.schedule, w)).persist()
    lt = regroup.listen_type_block(facts.listen_type_weighted(src.streams, src.on_demand, w, roll)).persist()
    pf = regroup.platform_block(facts.platform_duration(src.streams, w, roll)).persist()
    age = regroup.flag_block(facts.age_band(src.demographics, w), "age_band")
    gen = regroup.flag_block(facts.gender_flag(src.demographics, w), "gender")
    dp = facts.daypart_usage(src.streams, C.hour_dayparts(spark, segs), w, roll).where(F.col("key").isNotNull()).select(
        "segment", "gigya_id", F.col("key").alias("feature"), F.col("listen_number_time").cast("double").alias("value")
    )

    blocks = [
        regroup.rewrite(cat, regroup.category_rules(spark, cat, segs)),
        regroup.rewrite(pl, regroup.playlist_rules(spark, pl, segs, learned)),
        regroup.rewrite(lt, regroup.listen_type_rules(lt, segs)),
        regroup.rewrite(pf, regroup.platform_rules(spark, pf, segs, cfg.default_platform)),
        dp,
        regroup.rewrite(age, regroup.identity_rules(age, segs)),
        regroup.rewrite(gen, regroup.identity_rules(gen, segs)),
    ]
    union = blocks[0]
    for b in blocks[1:]:
        union = union.unionByName(b)
    cells_all = union.groupBy("segment", "gigya_id", "feature").agg(F.sum("value").alias("value"))
    return Assembly(spine=spine, cells_all=cells_all, structural=regroup.structural_catalog(spark, segs),
                    segments=segs, persisted=[roll, cat, pl, lt, pf])


def feature_matrix(asm: Assembly, ids: DataFrame | None = None) -> DataFrame:
    """Non-empty cells of every segment's matrix for the spine listeners (or ``ids``)."""
    keep = (ids if ids is not None else asm.spine).select("gigya_id")
    return asm.cells_all.join(keep, "gigya_id", "left_semi")


def matrix_rows(ids: DataFrame, segments: list[C.SegmentConfig]) -> DataFrame:
    """(segment, gigya_id): the rows of every segment's matrix, listeners without a cell included."""
    return ids.select(F.explode(F.array(*[F.lit(s.name) for s in segments])).alias("segment"), "gigya_id")


# ---------------------------------------------------------------------------------------------
# Outlier cut on the total listening time


def drop_top_listener(spine: DataFrame) -> DataFrame:
    """The spine without its single heaviest listener (ties: the smallest id goes).

    The top row is found with a one-row ordered limit (a per-partition top-1 merged on the
    driver side of the plan), then removed with an anti join against that one row."""
    top = spine.orderBy(F.col(TOTAL).desc(), F.col("gigya_id").asc()).limit(1).select("gigya_id")
    return spine.join(F.broadcast(top), "gigya_id", "left_anti")


def listen_quantiles(spine: DataFrame, probs=(0.25, 0.95)) -> list[float | None]:
    return exact_quantiles(drop_top_listener(spine), TOTAL, list(probs))


def outlier_bounds(spine: DataFrame) -> tuple[float, float]:
    """(lower, upper) fences: lower = Q1 (25 %), upper = Q3 + 1.5 (Q3 - Q1) with Q3 the 95 %
    quantile, both over the spine without its heaviest listener."""
    q1, q3 = listen_quantiles(spine)
    if q1 is None:
        return (0.0, -1.0)
    return (q1, q3 + 1.5 * (q3 - q1))


def outlier_cut(spine: DataFrame) -> DataFrame:
    """Listeners kept by the outlier cut; the same for every segment, so computed once."""
    lo, hi = outlier_bounds(spine)
    rest = drop_top_listener(spine)
    x = F.col(TOTAL).cast("double")
    return rest.where((x >= F.lit(lo)) & (x <= F.lit(hi)))


# ---------------------------------------------------------------------------------------------
# Column statistics with implicit zeros


def feature_stats(cells: DataFrame, catalog: DataFrame, n_rows: int) -> DataFrame:
    """(segment, feature, n, min, max, sum, mean, stddev) per catalog column over ``n_rows``
    listeners, absent cells counting as 0. Computed from the present cells only: the zero part is
    merged in with the parallel variance formula, so the dense matrix is never built."""
    present = cells.groupBy("segment", "feature").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum("value").alias("s"),
        F.avg("value").alias("m"),
        F.var_pop("value").alias("vp"),
        F.min("value").alias("mn"),
        F.max("value").alias("mx"),
    )
    j = catalog.join(present, ["segment", "feature"], "left")
    n = F.lit(float(n_rows))
    cnt = F.coalesce(F.col("cnt"), F.lit(0)).cast("double")
    zeros = n - cnt
    has_zero = zeros > 0
    mean = F.coalesce(F.col("s"), F.lit(0.0)) / n
    m2 = F.coalesce(F.col("vp") * cnt, F.lit(0.0)) + F.coalesce(F.col("m"), F.lit(0.0)) ** 2 * cnt * zeros / n
    return j.select(
        "segment",
        "feature",
        F.lit(n_rows).cast("bigint").alias("n"),
        F.when(has_zero, F.least(F.coalesce(F.col("mn"), F.lit(0.0)), F.lit(0.0))).otherwise(F.col("mn")).alias("min"),
        F.when(has_zero, F.greatest(F.coalesce(F.col("mx"), F.lit(0.0)), F.lit(0.0))).otherwise(F.col("mx")).alias("max"),
        F.coalesce(F.col("s"), F.lit(0.0)).alias("sum"),
        mean.alias("mean"),
        F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1))).alias("stddev"),
    )


# ---------------------------------------------------------------------------------------------
# Wide form


def pivot(cells: DataFrame, values: list[str], agg: str = "sum") -> DataFrame:
    """(gigya_id, feature, value) -> one row per id, one column per listed value, missing -> 0.

    The value list is always passed, so the schema does not depend on the data and Spark does
    not run a job to discover it; a value outside the list is ignored."""
    fn = {"sum": F.sum, "max": F.max, "first": F.first}[agg]
    wide = cells.groupBy("gigya_id").pivot("feature", values).agg(fn("value"))
    return wide.fillna(0.0, subset=values)


def pivot_all(cells: DataFrame, values: list[str], other: str = "other") -> DataFrame:
    """(segment, gigya_id, feature, value) -> one row per segment and id, a column per listed value and one for the sum of
    all others (NULL features too), missing -> 0. The columns of a row add up to its cells."""
    if other in values:
        raise ValueError(f"{other!r} is a listed value; name the rest otherwise")
    named = cells.withColumn("feature", F.when(F.col("feature").isin(values), F.col("feature")).otherwise(F.lit(other)))
    wide = named.groupBy("segment", "gigya_id").pivot("feature", [*values, other]).agg(F.sum("value"))
    return wide.fillna(0.0, subset=[*values, other])
