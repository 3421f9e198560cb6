"""Segment configuration and the small tables derived from it.

A run is parameterised by a control document (dates, per-segment ``is_main`` and ``weight_dict``)
and, per segment, four mapping documents: daypart hours, podcast-category groups, playlist groups
(with the ``live`` list and ``prev_playlists``) and the column template. These are configuration,
not data: they are parsed on the driver (key order matters and must be kept) and turned into
small DataFrames with one row per rule, which every operator broadcasts. Their size is bounded by
the configuration (segments x rules), never by the listening data.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from listenscape.sources import files

STAGES = ("stage_1", "stage_2", "stage_3", "stage_4", "stage_5", "stage_6")


@dataclass
class SegmentConfig:
    name: str
    is_main: bool
    weights: dict[str, float]
    dayparts: dict[str, tuple[int, int]]
    category_groups: list[str]
    playlist_map: dict[str, list[str]] = field(default_factory=dict)
    live: list[str] = field(default_factory=list)
    prev_playlists: list[str] = field(default_factory=list)
    template: dict[str, list[str]] = field(default_factory=dict)

    def validate(self) -> None:
        for name, hours in self.dayparts.items():
            if len(hours) != 2 or not all(isinstance(h, int) for h in hours):
                raise ValueError(f"{self.name}: daypart {name!r} must be [from_hour, to_hour], got {hours!r}")
        for group, members in self.playlist_map.items():
            if not isinstance(members, list):
                raise ValueError(f"{self.name}: playlist group {group!r} must list members")
        for stage in self.template:
            if stage not in STAGES:
                raise ValueError(f"{self.name}: unknown template stage {stage!r}")


@dataclass
class RunConfig:
    segments: list[SegmentConfig]
    run_date: str
    version: str = "v1"
    default_platform: str = "Web"

    def main_segments(self) -> list[SegmentConfig]:
        """Segments that run this week (``is_main``)."""
        return [s for s in self.segments if s.is_main]


# ---------------------------------------------------------------------------------------------
# Loading the documents


def _parse(path: str, text: str):
    try:
        return json.loads(text)
    except json.JSONDecodeError as exc:
        raise ValueError(f"invalid mapping document {path}: {exc}") from exc


def load_run_config(control_path: str, mapping_root: str, default_platform: str = "Web", spark: SparkSession | None = None) -> RunConfig:
    """Read a control document and the per-segment mapping folders `<root>/<SEG>/...` through Spark's file
    sources, so that both may lie on any file system that Spark reads.

    A document is known by its segment folder and its name, the extension in any case. A segment without
    a playlist map gets an empty one; documents of other names are passed over. Each document read is validated.
    """
    spark = spark or SparkSession.builder.getOrCreate()
    (control_text,) = files.read_mapping_documents(spark, control_path).values()
    control = _parse(control_path, control_text)
    found = {}
    for path, text in sorted(files.read_mapping_documents(spark, mapping_root).items()):
        *_, folder, name = ("/" + path).split("/")
        stem, ext = os.path.splitext(name)
        if ext.lower() == ".json":
            found.setdefault((folder, stem), (path, text))

    def document(folder: str, stem: str) -> dict:
        return _parse(*found[folder, stem]) if (folder, stem) in found else {}

    segments = []
    for name, seg in control["segment"].items():
        playlist = document(name, f"playlist_group_map_{name}")
        cfg = SegmentConfig(
            name=name,
            is_main=bool(seg.get("is_main", False)),
            weights=dict(seg.get("weight_dict", {})),
            dayparts={k: tuple(v) for k, v in document(name, f"daypart_{name}").items()},
            category_groups=list(document(name, f"podcast_category_map_{name}")),
            playlist_map=dict(playlist.get("map", {})),
            live=list(playlist.get("live", [])),
            prev_playlists=list(playlist.get("prev_playlists", [])),
            template=document(name, f"{name}_template"),
        )
        cfg.validate()
        segments.append(cfg)
    return RunConfig(segments=segments, run_date=control["start_date"], version=control.get("version", "v1"),
                     default_platform=default_platform)


# ---------------------------------------------------------------------------------------------
# Config tables


def _df(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def hour_dayparts(spark: SparkSession, segments: list[SegmentConfig]) -> DataFrame:
    """(segment, hour, daypart): for each of the 24 hours, the first daypart in map order whose
    inclusive [from, to] range contains it, or NULL when none does."""
    rows = []
    for seg in segments:
        for hour in range(24):
            chosen = None
            for name, (lo, hi) in seg.dayparts.items():
                if lo <= hour <= hi:
                    chosen = name
                    break
            rows.append((seg.name, hour, chosen))
    return _df(spark, rows, "segment string, hour int, daypart string")


def category_tokens(spark: SparkSession, segments: list[SegmentConfig]) -> DataFrame:
    """(segment, group, group_pos, token) of the podcast-category groups.

    A group name is split on '_' into tokens; a category joins the first group (map order) with a
    token that is a case-sensitive substring of it. The empty token (from '__') and the token
    `Group` itself would match everything or nothing useful and are left out.
    """
    rows = []
    for seg in segments:
        for pos, group in enumerate(seg.category_groups):
            for token in dict.fromkeys(group.split("_")):
                if token and token != "Group":
                    rows.append((seg.name, group, pos, token))
    return _df(spark, rows, "segment string, group string, group_pos int, token string")


def category_group_names(spark: SparkSession, segments: list[SegmentConfig]) -> DataFrame:
    rows = [(seg.name, g, pos) for seg in segments for pos, g in enumerate(seg.category_groups)]
    return _df(spark, rows, "segment string, group string, group_pos int")


def playlist_groups(spark: SparkSession, segments: list[SegmentConfig]) -> DataFrame:
    """(segment, group, group_pos, n_members, is_live) for every group of the map."""
    rows = []
    for seg in segments:
        live = set(seg.live)
        for gpos, (group, members) in enumerate(seg.playlist_map.items()):
            rows.append((seg.name, group, gpos, len(members), group in live))
    return _df(spark, rows, "segment string, group string, group_pos int, n_members int, is_live boolean")


def live_groups(spark: SparkSession, segments: list[SegmentConfig]) -> DataFrame:
    rows = [(seg.name, g) for seg in segments for g in dict.fromkeys(seg.live)]
    return _df(spark, rows, "segment string, group string")


def template_columns(spark: SparkSession, segments: list[SegmentConfig]) -> DataFrame:
    """(segment, stage, column) of the templates."""
    rows = []
    for seg in segments:
        for stage, names in seg.template.items():
            for name in dict.fromkeys(names):
                rows.append((seg.name, stage, name))
    return _df(spark, rows, "segment string, stage string, column string")


def previous_playlists(spark: SparkSession, segments: list[SegmentConfig]) -> DataFrame:
    rows = [(seg.name, p) for seg in segments for p in dict.fromkeys(seg.prev_playlists)]
    return _df(spark, rows, "segment string, member string")


def weights(spark: SparkSession, segments: list[SegmentConfig]) -> DataFrame:
    """(segment, feature, weight, weight_pos). Only the keys select strong features; the values
    are stored for the record."""
    rows = [
        (seg.name, f, float(w), pos)
        for seg in segments
        for pos, (f, w) in enumerate(seg.weights.items())
    ]
    return _df(spark, rows, "segment string, feature string, weight double, weight_pos int")


def segments_table(spark: SparkSession, segments: list[SegmentConfig]) -> DataFrame:
    return _df(spark, [(s.name, s.is_main) for s in segments], "segment string, is_main boolean")


SEGMENT_SCHEMA = T.StructType([T.StructField("segment", T.StringType())])
