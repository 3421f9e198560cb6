"""Listening sessions cut into ten-minute slots and attributed to broadcast shows.

Chain: streams -> slots (generator, no join) -> slot groups with their stream brand (dimension
join) -> interval join with the schedule on (brand, hour bucket) -> playlist / show seconds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenscape.functions import expressions as X
from listenscape.operators.facts import scan_streams
from listenscape.sources.window import RunWindow

BUCKET_SECONDS = 3600


def listening_slots(streams: DataFrame, window: RunWindow) -> DataFrame:
    """One row per (stream, n) slot of at most 600 s.

    For n = 0, 1, .. with 600*n < duration + 600 and start + 600*n < actual end, the slot runs from
    start + 600*n to the earlier of start + 600*(n+1) and the actual end; its seconds are the
    whole-second clock difference (wrapping at midnight). Only a NULL id is excluded here (an
    empty id survives, as in the playlist branch upstream). The number generator is an
    ``explode(sequence(..))`` inside the stream's own row, so no join with a numbers table or
    self-join on the stream id is needed; the row's own duration bounds it.
    """
    s = scan_streams(streams, window).where(F.col("gigya_id").isNotNull())
    last = F.floor((F.col("duration") + (X.SLOT_SECONDS - 1)) / X.SLOT_SECONDS).cast("bigint")
    # A negative bound (duration below -599 s) means no slot; NULL arrays explode to no rows.
    numbers = F.when(last >= 0, F.sequence(F.lit(0).cast("bigint"), last))
    exploded = s.select(
        "gigya_id", "stream_id", "stream_name", "duration", "request_start", "request_end",
        F.explode(numbers).alias("n"),
    )
    slot_start = X.plus_seconds("request_start", F.col("n") * X.SLOT_SECONDS)
    potential_end = X.plus_seconds("request_start", (F.col("n") + 1) * X.SLOT_SECONDS)
    slots = exploded.select(
        "gigya_id", "stream_id", "stream_name", "n",
        slot_start.alias("slot_start"),
        X.earlier(potential_end, F.col("request_end")).alias("slot_end"),
        F.col("request_end").alias("actual_end"),
    ).where(F.col("slot_start") < F.col("actual_end"))
    return slots.select(
        "gigya_id", "stream_id", "stream_name", "n", "slot_start", "slot_end",
        X.clock_seconds_between("slot_start", "slot_end").alias("slot_seconds"),
    )


def schedule_brand(schedule: DataFrame, window: RunWindow) -> DataFrame:
    """Distinct in-window schedule rows with the brand derived from the station name."""
    return (
        schedule.where(window.timestamps("show_start"))
        .select(
            "show_id", "fqsn", X.station_brand("fqsn").alias("brand"),
            F.col("show_start"), F.col("show_end"), "show_long_name",
        )
        .distinct()
    )


def slot_brand(streams: DataFrame, stream_map: DataFrame, window: RunWindow) -> DataFrame:
    """Slot seconds summed per (id, stream name, mapping, slot start, slot end) with the brand
    the stream is scheduled under. Streams without a mapping keep NULL brand and playlist."""
    slots = listening_slots(streams, window)
    per_slot = slots.groupBy("gigya_id", "stream_name", "slot_start", "slot_end").agg(
        F.sum("slot_seconds").alias("seconds")
    )
    return _branded(per_slot, stream_map).drop("first_part")


def _branded(slots: DataFrame, stream_map: DataFrame) -> DataFrame:
    # The names are formed once per stream of the mapping, not once per slot.
    named = stream_map.select(
        "stream_name",
        X.stream_brand("playlist_pruned", "channel", "playlist").alias("brand_name"),
        F.col("playlist_pruned").alias("playlists"),
        X.part("playlist_pruned", "_", 1).alias("first_part"),
    )
    return slots.join(named, "stream_name", "left").select(
        "gigya_id", "stream_name", "brand_name", "playlists", "first_part", "slot_start", "slot_end", "seconds")


def _hour_bucket(ts) -> F.Column:
    return F.floor(F.unix_timestamp(ts) / BUCKET_SECONDS)


def _last_bucket(window: RunWindow) -> int:
    """The first hour after the day behind the window. Few slots begin later, those of very long sessions."""
    days = (window.end - dt.date(1970, 1, 1)).days + 2
    return days * 86400 // BUCKET_SECONDS


def slot_bucket(ts: F.Column, window: RunWindow) -> F.Column:
    """The bucket of a slot start: its hour, or beyond the last hour one bucket per weekday."""
    last = _last_bucket(window)
    return F.when(_hour_bucket(ts) < last, _hour_bucket(ts)).otherwise(F.lit(last) + F.dayofweek(ts))


def show_buckets(start: F.Column, end: F.Column, window: RunWindow) -> F.Column:
    """The buckets in which a show can meet a slot: the hours it covers on its own weekday, up to the last one, and
    its weekday's bucket beyond. An open-ended show has at most five days of hours and one more."""
    last = _last_bucket(window)
    hours = F.filter(F.sequence(_hour_bucket(start), F.least(_hour_bucket(end), F.lit(last - 1))),
                     lambda h: F.dayofweek(F.timestamp_seconds(h * BUCKET_SECONDS)) == F.dayofweek(start))
    beyond = F.when(_hour_bucket(end) >= last, F.array((F.lit(last) + F.dayofweek(start)).cast("bigint")))
    return F.when(end >= start, F.concat(hours, F.coalesce(beyond, F.array().cast("array<bigint>"))))


def bucketed_shows(stream_map: DataFrame, schedule: DataFrame, window: RunWindow) -> DataFrame:
    """(brand, show_start, show_end, show_long_name, bucket) of the shows whose brand some stream carries. The brand is
    derived once per station name, and the semi-join comes first, so that only these shows are made distinct and expanded."""
    carried = stream_map.select(X.stream_brand("playlist_pruned", "channel", "playlist").alias("brand")).where("brand IS NOT NULL").distinct()
    # From the smallest of equal names: of the key itself, rules and semi-join would move below the grouping, onto every row.
    stations = schedule.groupBy("fqsn").agg(F.min("fqsn").alias("name")).select("fqsn", X.station_brand("name").alias("brand"))
    stations = stations.join(carried, "brand", "left_semi")
    own = schedule.where(window.timestamps("show_start")).join(F.broadcast(stations), "fqsn")
    return own.select("show_id", "fqsn", "brand", "show_start", "show_end", "show_long_name").distinct().select(
        "brand", "show_start", "show_end", "show_long_name",
        F.explode(show_buckets(F.col("show_start"), F.col("show_end"), window)).alias("bucket"))


def show_match(streams: DataFrame, stream_map: DataFrame, schedule: DataFrame, window: RunWindow,
               half_open: bool = False) -> DataFrame:
    """Interval join of slot groups with the shows of their brand.

    A slot matches a show of the same brand when show_start <= slot_start <= show_end (both
    inclusive, so a slot on a boundary between two shows matches both unless ``half_open``) and
    the slot starts on the same weekday the show started. Unmatched slots keep NULL show columns.

    Physical plan: each show is expanded into the buckets it can meet slots in and the join is an
    equi-join on (brand, bucket of the slot start) with the exact range as a residual. A slot
    meets each show in exactly one bucket, so no duplicates arise, and the probe work per slot is
    bounded by the shows of its brand in one hour rather than in four weeks. The schedule side is
    small (shows x hours) and AQE broadcasts it when its measured size is under the threshold;
    otherwise the join stays a shuffled hash / sort-merge join on (brand, bucket), whose slot side (the
    outer one) AQE splits where a brand has most of the slots of an hour.
    """
    branded = slot_brand(streams, stream_map, window).withColumn("first_part", F.lit(None).cast("string"))
    return _matched(branded, bucketed_shows(stream_map, schedule, window), window, half_open).drop("first_part")


def _matched(slots: DataFrame, shows: DataFrame, window: RunWindow, half_open: bool) -> DataFrame:
    slots = slots.withColumn("bucket", slot_bucket(F.col("slot_start"), window))
    upper = (F.col("slot_start") < F.col("show_end")) if half_open else (F.col("slot_start") <= F.col("show_end"))
    cond = (
        (F.col("brand_name") == F.col("brand"))
        & (slots["bucket"] == shows["bucket"])
        & (F.col("slot_start") >= F.col("show_start"))
        & upper
        & (F.dayofweek("slot_start") == F.dayofweek("show_start"))
    )
    joined = slots.join(shows, cond, "left")
    return joined.select(
        "gigya_id", "brand_name", "playlists", "first_part", "slot_start", "slot_end", "seconds",
        "show_long_name",
        F.when(F.col("show_long_name").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("tag"),
    )


def playlist_duration(streams: DataFrame, stream_map: DataFrame, schedule: DataFrame, window: RunWindow,
                      half_open: bool = False) -> DataFrame:
    """Seconds per (id, playlist): unmatched slots count under the stream's pruned playlist name,
    matched ones under `<first '_' part of it>_<show name>`.

    The sum is additive, so the slots are not summed by themselves first: where the two dimensions
    are broadcast, the partial sums by (id, playlist) are the only exchange on the slot side."""
    slots = listening_slots(streams, window).withColumnRenamed("slot_seconds", "seconds")
    m = _matched(_branded(slots, stream_map), bucketed_shows(stream_map, schedule, window), window, half_open)
    playlist = F.when(F.col("tag") == 0, F.col("playlists")).otherwise(
        F.concat(F.col("first_part"), F.lit("_"), F.col("show_long_name"))
    )
    return m.groupBy("gigya_id", playlist.alias("playlist")).agg(F.sum("seconds").alias("total_duration"))
