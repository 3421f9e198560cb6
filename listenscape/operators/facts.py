"""Segment-independent listening facts (the weekly "master tables").

Every function takes source DataFrames plus the run window and returns a small long-form fact
`(gigya_id, key, measure)`. Facts are aggregated before any join so that the big stream log is
shuffled once, on its grouping key, with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenscape.functions import expressions as X
from listenscape.sources.window import RunWindow


# ---------------------------------------------------------------------------------------------
# Scans (S1, S2, S3, P2, P5)


def scan_streams(streams: DataFrame, window: RunWindow) -> DataFrame:
    """Streams whose request started inside the window (any id, NULL and '' included)."""
    return streams.where(window.timestamps("request_start"))


def scan_on_demand(on_demand: DataFrame, window: RunWindow) -> DataFrame:
    return on_demand.where(window.dates("p_listen_date"))


def valid_streams(streams: DataFrame, window: RunWindow) -> DataFrame:
    """In-window streams with a non-empty listener id (drops '' and NULL)."""
    return scan_streams(streams, window).where(X.non_empty_id("gigya_id"))


def valid_ids(streams: DataFrame, window: RunWindow) -> DataFrame:
    """Distinct non-empty ids with their number of in-window streams."""
    return valid_streams(streams, window).groupBy("gigya_id").agg(F.count(F.lit(1)).alias("n_streams"))


def consented(consent: DataFrame) -> DataFrame:
    """Distinct ids whose consent status contains `consent_given` (LIKE, so `_` is a wildcard)."""
    return consent.where(X.consent_given("consent_status")).select("gigya_id").distinct()


def consent_filter(consent: DataFrame) -> DataFrame:
    """Consenting ids and how many consent rows each has (duplicates are visible here)."""
    return (
        consent.where(X.consent_given("consent_status"))
        .groupBy("gigya_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


# ---------------------------------------------------------------------------------------------
# One pass over the stream log for every per-listener stream aggregate


ROLLUP_KEYS = ("gigya_id", "platform", "listener_id", "hour", "weekpart")
LEVEL_ID = ("gigya_id",)
LEVEL_PLATFORM = ("gigya_id", "platform")
LEVEL_LISTENER = ("gigya_id", "listener_id")
LEVEL_DAYPART = ("gigya_id", "hour", "weekpart")


def stream_rollup(streams: DataFrame, window: RunWindow) -> DataFrame:
    """Seconds and stream counts of the in-window streams (id not NULL) at four grouping levels
    - id; id x platform; id x listener; id x hour x weekpart - computed from ONE scan of the
    stream log with GROUPING SETS (one Expand, map-side partial aggregation, one shuffle on the
    grouping keys). `level` names the grouping set of each row. Every level groups by the id, so
    the empty-id rows can be filtered after aggregation where a fact needs it."""
    s = scan_streams(streams, window).where(F.col("gigya_id").isNotNull()).select(
        "gigya_id", "platform", "listener_id", "duration",
        F.hour("request_start").alias("hour"),
        X.weekpart("request_start").alias("weekpart"),
    )
    sets = [list(LEVEL_ID), list(LEVEL_PLATFORM), list(LEVEL_LISTENER), list(LEVEL_DAYPART)]
    g = s.groupingSets(sets, *ROLLUP_KEYS).agg(
        F.sum("duration").alias("seconds"),
        F.count(F.lit(1)).alias("n_streams"),
        F.grouping_id(*ROLLUP_KEYS).alias("gid_bits"),
    )
    level = F.lit(None).cast("string")
    for name, keys in (("id", LEVEL_ID), ("platform", LEVEL_PLATFORM), ("listener", LEVEL_LISTENER),
                       ("daypart", LEVEL_DAYPART)):
        bits = sum(1 << (len(ROLLUP_KEYS) - 1 - i) for i, k in enumerate(ROLLUP_KEYS) if k not in keys)
        level = F.when(F.col("gid_bits") == bits, F.lit(name)).otherwise(level)
    return g.withColumn("level", level).drop("gid_bits")


LEVELS = {"id": LEVEL_ID, "platform": LEVEL_PLATFORM, "listener": LEVEL_LISTENER, "daypart": LEVEL_DAYPART}


def _level(rollup: DataFrame, name: str, valid: bool = True) -> DataFrame:
    r = rollup.where(F.col("level") == name)
    return r.where(X.non_empty_id("gigya_id")) if valid else r


def _single_level(streams: DataFrame, window: RunWindow, name: str, valid: bool = True) -> DataFrame:
    """The same rows as one level of ``stream_rollup``, aggregated on their own: used when a fact
    is computed alone, so it does not pay for the other grouping sets."""
    s = scan_streams(streams, window).where(F.col("gigya_id").isNotNull())
    if valid:
        s = s.where(X.non_empty_id("gigya_id"))
    s = s.select(
        "gigya_id", "platform", "listener_id", "duration",
        F.hour("request_start").alias("hour"),
        X.weekpart("request_start").alias("weekpart"),
    )
    return s.groupBy(*LEVELS[name]).agg(
        F.sum("duration").alias("seconds"), F.count(F.lit(1)).alias("n_streams")
    )


def _stream_level(streams: DataFrame, window: RunWindow, rollup: DataFrame | None, name: str,
                  valid: bool = True) -> DataFrame:
    if rollup is None:
        return _single_level(streams, window, name, valid)
    return _level(rollup, name, valid)


# ---------------------------------------------------------------------------------------------
# Duration facts


def total_duration(streams: DataFrame, consent: DataFrame, window: RunWindow,
                   rollup: DataFrame | None = None) -> DataFrame:
    """Total listening seconds of each consenting id with streams in the window: the spine.

    The consent map is reduced to distinct ids and semi-joined, so a duplicated consent row does
    not multiply a listener's total (the warehouse join did). The semi join runs after the
    partial aggregation of the stream log, so only one row per id crosses the join.
    """
    per_id = _stream_level(streams, window, rollup, "id", valid=False).select("gigya_id", F.col("seconds").alias("total_listen_time"))
    return per_id.join(consented(consent), "gigya_id", "left_semi")


def platform_duration(streams: DataFrame, window: RunWindow, rollup: DataFrame | None = None) -> DataFrame:
    """Seconds listened per id and platform (named PLAYER_COUNT upstream although it is a sum)."""
    return _stream_level(streams, window, rollup, "platform").select("gigya_id", "platform", F.col("seconds").alias("player_count"))


# ---------------------------------------------------------------------------------------------
# On-demand facts


#: Left rows of one listener that a join task takes; a listener with more is dealt over several.
ROWS_PER_TASK = 1 << 17


def fan_out(left: DataFrame, right: DataFrame, key: str = "listener_id", rows: int = ROWS_PER_TASK) -> DataFrame:
    """``left`` joined (left outer) to the rows of ``right`` with the same key, where one key may hold a large share of
    both sides. Keys with more than ``rows`` left rows are measured; their left rows are dealt over several salts and
    their right rows repeated for each. Left rows without a key match nothing and are dealt by their own hash.

    The table of such keys is broadcast: it has fewer than (left rows / ``rows``) rows of two numbers.
    """
    others = [c for c in left.columns if c != key]
    # The maximum keeps all columns in the plan, so that the count reads the same exchange as the join.
    heavy = (left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(*others)).alias("_any"))
             .where((F.col("_n") > rows) & F.col("_any").isNotNull()).select(key, F.ceil(F.col("_n") / rows).cast("int").alias("_salts")))
    place = F.xxhash64(*others)
    dealt = left.join(F.broadcast(heavy), key, "left").withColumn(
        "_salt", F.when(F.col(key).isNull(), F.pmod(place, F.lit(1 << 16))).otherwise(F.pmod(place, F.coalesce("_salts", F.lit(1)))).cast("int"))
    copies = right.join(F.broadcast(heavy), key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
    return dealt.drop("_salts").join(copies.drop("_salts"), [key, "_salt"], "left").drop("_salt")


def _streams_per_listener(streams: DataFrame, window: RunWindow, rollup: DataFrame | None = None) -> DataFrame:
    """(gigya_id, listener_id, n_streams): the stream side of the fan-out joins, pre-counted."""
    return _stream_level(streams, window, rollup, "listener").select("gigya_id", "listener_id", "n_streams")


def category_freq(on_demand: DataFrame, episode_category: DataFrame, window: RunWindow) -> DataFrame:
    """On-demand plays per listener and podcast category; unmapped episodes count under NULL.

    An episode with several categories counts once for each (the map expands the plays).
    The category map is aggregated to (episode, category, multiplicity) first so that the join
    key is unique on the dimension side.
    """
    plays = (
        scan_on_demand(on_demand, window)
        .groupBy("listener_id", "episode_id")
        .agg(F.count(F.lit(1)).alias("n_plays"))
    )
    cats = episode_category.groupBy("episodeid", "category").agg(F.count(F.lit(1)).alias("n_rows"))
    joined = plays.join(cats, plays.episode_id == cats.episodeid, "left")
    return joined.groupBy("listener_id", "category").agg(
        F.sum(F.col("n_plays") * F.coalesce(F.col("n_rows"), F.lit(1))).alias("listen_freq")
    )


def category_weighted(streams: DataFrame, on_demand: DataFrame, episode_category: DataFrame,
                      window: RunWindow, rollup: DataFrame | None = None) -> DataFrame:
    """Per id and category: sum over the id's streams of its listener's play count.

    The warehouse joined every stream row to every category row of its listener; here both sides
    are counted first and the join multiplies counts, which gives the same sums on far fewer rows.
    A listener without plays keeps one row with NULL category and NULL count.
    """
    per_listener = _streams_per_listener(streams, window, rollup)
    freq = category_freq(on_demand, episode_category, window)
    joined = fan_out(per_listener, freq)
    return joined.groupBy("gigya_id", "category").agg(
        F.sum(F.col("n_streams") * F.col("listen_freq")).alias("listen_duration")
    )


def listen_type_freq(on_demand: DataFrame, window: RunWindow) -> DataFrame:
    """Plays per listener and on-demand type; COUNT of the type, so the NULL type counts 0."""
    return (
        scan_on_demand(on_demand, window)
        .groupBy("listener_id", "aod_type")
        .agg(F.count("aod_type").alias("listen_freq"))
    )


def listen_type_weighted(streams: DataFrame, on_demand: DataFrame, window: RunWindow,
                         rollup: DataFrame | None = None) -> DataFrame:
    per_listener = _streams_per_listener(streams, window, rollup)
    freq = listen_type_freq(on_demand, window)
    joined = fan_out(per_listener, freq)
    return joined.groupBy("gigya_id", "aod_type").agg(
        F.sum(F.col("n_streams") * F.col("listen_freq")).alias("total_listen_time")
    )


# ---------------------------------------------------------------------------------------------
# Demographic facts (D-5, D-6, A9)


def age_band(demographics: DataFrame, window: RunWindow) -> DataFrame:
    return (
        demographics.where(window.timestamps("request_start"))
        .select(F.col("pers_id").alias("gigya_id"), X.age_band("pers_age").alias("age_band"),
                F.lit(1).alias("age_bool"))
        .distinct()
    )


def gender_flag(demographics: DataFrame, window: RunWindow) -> DataFrame:
    return (
        demographics.where(window.timestamps("request_start"))
        .select(F.col("pers_id").alias("gigya_id"), X.gender("pers_gender").alias("gender"),
                F.lit(1).alias("gender_bool"))
        .distinct()
    )


# ---------------------------------------------------------------------------------------------
# Daypart x weekpart, all segments in one pass (A8, D-7)


def daypart_usage(streams: DataFrame, hour_dayparts: DataFrame, window: RunWindow,
                  rollup: DataFrame | None = None) -> DataFrame:
    """Seconds per (segment, id, DAYPART_WEEKPART), for every segment at once.

    ``hour_dayparts`` is the config table `(segment, hour, daypart)` with, for each segment, the
    first daypart in map order that contains the hour (``plans.config.hour_dayparts``); it has at
    most 24 rows per segment and is broadcast. The stream log is first reduced to
    (id, hour, weekpart) sums (a level of ``stream_rollup``), so the expansion by segment multiplies a small aggregate rather
    than raw streams. An hour no daypart covers gives a NULL key, as the generated CASE did.
    """
    base = _stream_level(streams, window, rollup, "daypart").select("gigya_id", "hour", "weekpart", "seconds")
    # Every segment must see every hour, also hours its map leaves uncovered (NULL key), so the
    # expansion is an equi-join on the hour against a table that lists all 24 hours per segment.
    joined = base.join(F.broadcast(hour_dayparts), "hour", "inner")
    keyed = joined.select(
        "segment",
        "gigya_id",
        F.concat(F.col("daypart"), F.lit("_"), F.col("weekpart")).alias("key"),
        "seconds",
    )
    return keyed.groupBy("segment", "gigya_id", "key").agg(F.sum("seconds").alias("listen_number_time"))
