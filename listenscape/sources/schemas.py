"""Declared schemas of the seven listening sources (never inferred from data)."""

from __future__ import annotations

from pyspark.sql import types as T

STREAMS = T.StructType(
    [
        T.StructField("stream_id", T.StringType()),
        T.StructField("gigya_id", T.StringType()),
        T.StructField("listener_id", T.LongType()),
        T.StructField("stream_name", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("duration", T.LongType()),
        T.StructField("request_start", T.TimestampType()),
        T.StructField("request_end", T.TimestampType()),
    ]
)

ON_DEMAND = T.StructType(
    [
        T.StructField("listener_id", T.LongType()),
        T.StructField("episode_id", T.LongType()),
        T.StructField("aod_type", T.StringType()),
        T.StructField("p_listen_date", T.DateType()),
        T.StructField("channel_id", T.LongType()),
    ]
)

CONSENT = T.StructType(
    [
        T.StructField("gigya_id", T.StringType()),
        T.StructField("consent_status", T.StringType()),
    ]
)

EPISODE_CATEGORY = T.StructType(
    [
        T.StructField("episodeid", T.LongType()),
        T.StructField("category", T.StringType()),
    ]
)

STREAM_MAP = T.StructType(
    [
        T.StructField("stream_name", T.StringType()),
        T.StructField("playlist_pruned", T.StringType()),
        T.StructField("playlist", T.StringType()),
        T.StructField("channel", T.StringType()),
    ]
)

SCHEDULE = T.StructType(
    [
        T.StructField("show_id", T.LongType()),
        T.StructField("fqsn", T.StringType()),
        T.StructField("show_start", T.TimestampType()),
        T.StructField("show_end", T.TimestampType()),
        T.StructField("show_long_name", T.StringType()),
    ]
)

DEMOGRAPHICS = T.StructType(
    [
        T.StructField("pers_id", T.StringType()),
        T.StructField("pers_age", T.IntegerType()),
        T.StructField("pers_gender", T.StringType()),
        T.StructField("request_start", T.TimestampType()),
    ]
)

CHANNELS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
    ]
)

ALL = {
    "streams": STREAMS,
    "on_demand": ON_DEMAND,
    "consent": CONSENT,
    "episode_category": EPISODE_CATEGORY,
    "stream_map": STREAM_MAP,
    "schedule": SCHEDULE,
    "demographics": DEMOGRAPHICS,
}
