"""Channel-level blocks that were switched off in the weekly job, kept as operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenscape.operators import facts
from listenscape.plans import config as C
from listenscape.sources.window import RunWindow

SPECIAL_MARK = "-M-"


# Channels with a name of their own, and marks of names that are kept whole.
RADIO_X, CAPITAL_XTRA = "Radio X", "Capital XTRA"
WHOLE_NAME_MARKS = ("70s", "80s", "00s", "DANCE", "Dance")
TEST_MARK = "Test"
DEFAULT_FEATURE = "Global_podcast"


def channel_name(name: str | F.Column) -> F.Column:
    """The brand of a channel: a name of its own, the whole name, or the part before the first blank."""
    c = F.col(name) if isinstance(name, str) else name
    whole = F.lit(False)
    for mark in WHOLE_NAME_MARKS:
        whole = whole | c.contains(mark)
    return (F.when(c.contains(RADIO_X), F.lit(RADIO_X)).when(c.contains("XTRA"), F.lit(CAPITAL_XTRA)).when(whole, c)
            .otherwise(F.regexp_replace(c, " .*", "")))


def channel_listen_type(streams: DataFrame, on_demand: DataFrame, channels: DataFrame, window: RunWindow,
                        known: list[str]) -> DataFrame:
    """(gigya_id, feature, value) with features `<channel>_<listen type>`: an id's stream seconds, counted once for every
    on-demand play of the stream's listener. Features outside ``known`` go to ``Global_podcast``; those of test
    channels, and plays without a channel or a type, have none.

    Streams and plays are summed per listener before they meet, so the fan-out is a product of counts.
    """
    per_listener = facts.valid_streams(streams, window).groupBy("gigya_id", "listener_id").agg(F.sum("duration").alias("seconds"))
    plays = (facts.scan_on_demand(on_demand, window).where("aod_type IS NOT NULL AND channel_id IS NOT NULL")
             .groupBy("listener_id", "channel_id", "aod_type").agg(F.count(F.lit(1)).alias("n")))
    named = plays.join(channels.select(F.col("id").alias("channel_id"), "name"), "channel_id")
    feature = F.concat_ws("_", channel_name("name"), F.col("aod_type"))
    per_feature = (named.where("name IS NOT NULL").select("listener_id", feature.alias("feature"), "n")
                   .where(~F.col("feature").contains(TEST_MARK))
                   .withColumn("feature", F.when(F.col("feature").isin(known), F.col("feature")).otherwise(DEFAULT_FEATURE))
                   .groupBy("listener_id", "feature").agg(F.sum("n").alias("n")))
    joined = facts.fan_out(per_listener, per_feature).where("feature IS NOT NULL")
    return joined.groupBy("gigya_id", "feature").agg(F.sum(F.col("seconds") * F.col("n")).alias("value"))


def channel_duration(streams: DataFrame, stream_map: DataFrame, window: RunWindow) -> DataFrame:
    """Seconds per (id, channel): valid in-window streams joined to the stream map on the name
    (unmapped streams count under a NULL channel). Streams are summed per (id, stream name) first,
    so the dimension join sees one row per pair."""
    per_name = (
        facts.valid_streams(streams, window)
        .groupBy("gigya_id", "stream_name")
        .agg(F.sum("duration").alias("seconds"))
    )
    joined = per_name.join(stream_map.select("stream_name", "channel"), "stream_name", "left")
    return joined.groupBy("gigya_id", "channel").agg(F.sum("seconds").alias("listen_time"))


def channel_playlist(spark: SparkSession, playlist_block: DataFrame, segments: list[C.SegmentConfig]) -> DataFrame:
    """(segment, gigya_id, feature, value) with feature `<channel>_playlist`: per listener, the sum
    of the special playlists (`<channel>-M-<name>`) the previous run listed, by channel."""
    prev = F.broadcast(C.previous_playlists(spark, segments))
    specials = playlist_block.where(F.col("member").contains(SPECIAL_MARK))
    j = specials.join(prev, "member", "inner")
    channel = F.split_part(F.col("member"), F.lit(SPECIAL_MARK), F.lit(1))
    return j.groupBy("segment", "gigya_id", F.concat(channel, F.lit("_playlist")).alias("feature")).agg(
        F.sum("value").alias("value")
    )
