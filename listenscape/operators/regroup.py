"""Per-segment regrouping of listening facts into named features, for all segments at once.

Each fact block is a long table `(gigya_id, member, value)` whose members are data values (podcast
categories, playlists, platforms, ...). A segment turns a member into one or more features:
group membership, the Live / Playlist totals, residual roll-ups, folds. Those decisions depend
only on the member name and the segment, so they are computed once on the small vocabulary
`(segment, member)` as a *rule table* `(segment, member, feature)`; the block is then joined to
the rules on the member and summed. The block is expanded by segment only through that join, after
it has been aggregated per (id, member).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenscape.plans import config as C

LIVE = "Live"
PLAYLIST = "Playlist"
SPECIALS = "Specials"
NEWSFLASH = "newsflash"
UNKNOWN_CATEGORY = "Unknown"
LIVE_STREAM_SUFFIX = "_Live_Stream"
SPECIAL_MARK = "-M-"


def _per_segment(vocab: DataFrame, segments: list[C.SegmentConfig]) -> DataFrame:
    """(segment, member) for every configured segment: an explode of the literal segment list
    (a generator bounded by the configuration), not a join."""
    names = F.array(*[F.lit(s.name) for s in segments])
    return vocab.select(F.explode(names).alias("segment"), "member")


def _stage_arrays(spark: SparkSession, segments: list[C.SegmentConfig]) -> DataFrame:
    rows = [
        (s.name, list(dict.fromkeys(s.template.get("stage_2", []))),
         list(dict.fromkeys(s.template.get("stage_4", []))),
         list(dict.fromkeys(s.template.get("stage_5", []))))
        for s in segments
    ]
    return spark.createDataFrame(
        rows, "segment string, stage_2 array<string>, stage_4 array<string>, stage_5 array<string>"
    )


def rewrite(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Apply a rule table to a block: (gigya_id, member, value) -> (segment, gigya_id, feature, value).

    The rule table is bounded by vocabulary x segments; AQE broadcasts it when it is small and
    falls back to a shuffled join on the member otherwise."""
    return df.join(rules, "member", "inner").select("segment", "gigya_id", "feature", "value")


# ---------------------------------------------------------------------------------------------
# Blocks (segment-independent)


def category_block(category_weighted: DataFrame) -> DataFrame:
    """Category fact as a block; an empty or NULL category is labelled `Unknown` (the template
    expects it) and a NULL count is 0."""
    member = F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit(UNKNOWN_CATEGORY))
    return category_weighted.select(
        "gigya_id", member.alias("member"), F.coalesce(F.col("listen_duration"), F.lit(0)).cast("double").alias("value")
    )


def playlist_block(playlist_duration: DataFrame) -> DataFrame:
    return playlist_duration.where(F.col("playlist").isNotNull()).select(
        "gigya_id", F.col("playlist").alias("member"), F.col("total_duration").cast("double").alias("value")
    )


def listen_type_block(listen_type_weighted: DataFrame) -> DataFrame:
    return listen_type_weighted.where(F.col("aod_type").isNotNull()).select(
        "gigya_id", F.col("aod_type").alias("member"), F.col("total_listen_time").cast("double").alias("value")
    )


def platform_block(platform_duration: DataFrame) -> DataFrame:
    return platform_duration.where(F.col("platform").isNotNull()).select(
        "gigya_id", F.col("platform").alias("member"), F.col("player_count").cast("double").alias("value")
    )


def flag_block(fact: DataFrame, key: str) -> DataFrame:
    """Age-band or gender presence flags; the unknown value `u` is not a feature."""
    return (
        fact.where(F.col(key) != F.lit("u"))
        .select("gigya_id", F.col(key).alias("member"), F.lit(1.0).alias("value"))
        .distinct()
    )


# ---------------------------------------------------------------------------------------------
# Podcast categories (F1, F2)


def category_rules(spark: SparkSession, block: DataFrame, segments: list[C.SegmentConfig]) -> DataFrame:
    """(segment, member, feature): a category joins the first group (map order) one of whose
    name tokens is a case-sensitive substring of it; other categories pass through unchanged.

    The join is an equi-join on the segment with the substring test as residual, between the
    category vocabulary and the token table (both small)."""
    vocab = _per_segment(block.select("member").distinct(), segments)
    tokens = F.broadcast(C.category_tokens(spark, segments))
    hits = vocab.join(tokens, (vocab.segment == tokens.segment) & vocab.member.contains(tokens.token), "left")
    chosen = hits.groupBy(vocab.segment, vocab.member).agg(
        F.min_by(tokens.group, tokens.group_pos).alias("group")
    )
    return chosen.select("segment", "member", F.coalesce("group", "member").alias("feature"))


def category_group(spark: SparkSession, category_weighted: DataFrame, segments: list[C.SegmentConfig]) -> DataFrame:
    """The assignment of each category present in the data to its group (NULL when ungrouped)."""
    rules = category_rules(spark, category_block(category_weighted), segments)
    return rules.select(
        "segment", F.col("member").alias("category"),
        F.when(F.col("feature") != F.col("member"), F.col("feature")).alias("category_group"),
    )


# ---------------------------------------------------------------------------------------------
# Playlists


def _first_groups(spark: SparkSession, segments: list[C.SegmentConfig]) -> DataFrame:
    """(segment, member, group, is_live): the first group (map order) listing each member.

    A member listed by several groups belongs to the first; later groups neither get it nor
    lose their other members (the net effect of consuming members in map order)."""
    rows = []
    for seg in segments:
        live = set(seg.live)
        seen = set()
        for group, members in seg.playlist_map.items():
            for m in members:
                if m not in seen:
                    seen.add(m)
                    rows.append((seg.name, m, group, group in live))
    return spark.createDataFrame(rows, "segment string, member string, group string, is_live boolean")


def member_groups(spark: SparkSession, segments: list[C.SegmentConfig], learned: DataFrame | None = None) -> DataFrame:
    """``_first_groups`` with the members that earlier runs appended to `Specials` (``learned``: segment, member). A
    group that the mapping document names goes first. Learned members follow the data, so they get no broadcast hint."""
    first = _first_groups(spark, segments)
    if learned is None:
        return F.broadcast(first)
    live = [s.name for s in segments if SPECIALS in s.live]
    more = learned.select("segment", "member").distinct().join(first, ["segment", "member"], "left_anti")
    return first.unionByName(more.select("segment", "member", F.lit(SPECIALS).alias("group"), F.col("segment").isin(live).alias("is_live")))


def _structural_playlist_features(spark: SparkSession, segments: list[C.SegmentConfig]) -> DataFrame:
    """Columns a segment has whatever the data: every group with a non-empty member list, Live
    and Playlist."""
    rows = []
    for seg in segments:
        for group, members in seg.playlist_map.items():
            if members:
                rows.append((seg.name, group))
        rows.append((seg.name, LIVE))
        rows.append((seg.name, PLAYLIST))
    return spark.createDataFrame(rows, "segment string, pre string")


def residual_target(pre: Column, stage_2: Column, stage_4: Column) -> Column:
    """Features a pre-roll-up column ends up in (array), after the residual roll-up.

    * in the template (stage_2): itself;
    * a special (`-M-` in the name): `Specials`;
    * its first `_` part (or that part without `News`) is a stage_4 brand: added to
      `<brand>_Live_Stream`, and dropped unless its own name contains `_Live_Stream`; a column is
      never added to itself (a live-stream group the template spells differently stays as is);
    * anything else: kept and reported.
    """
    prefix = F.split_part(pre, F.lit("_"), F.lit(1))
    brand = F.replace(prefix, F.lit("News"), F.lit(""))
    target = F.concat(brand, F.lit(LIVE_STREAM_SUFFIX))
    to_brand = (
        F.when(target == pre, F.array(pre))
        .when(pre.contains(LIVE_STREAM_SUFFIX), F.array(pre, target))
        .otherwise(F.array(target))
    )
    return (
        F.when(F.array_contains(stage_2, pre), F.array(pre))
        .when(pre.contains(SPECIAL_MARK), F.array(F.lit(SPECIALS)))
        .when(F.array_contains(stage_4, prefix) | F.array_contains(stage_4, brand), to_brand)
        .otherwise(F.array(pre))
    )


def playlist_rule_rows(spark: SparkSession, block: DataFrame, segments: list[C.SegmentConfig],
                       learned: DataFrame | None = None) -> DataFrame:
    """(segment, member, pre, feature) for the members present in the data.

    `pre` is the column after grouping and the Live / Playlist totals (a member of a live group
    also counts in Live, of any other group in Playlist; these totals are formed before the
    roll-up, so rolled-up shows are not in them); `feature` is where it lands after the roll-up."""
    vocab = _per_segment(block.select("member").distinct(), segments)
    first = member_groups(spark, segments, learned)
    v = vocab.join(first, ["segment", "member"], "left")
    empty = F.array().cast("array<string>")
    pres = F.concat(
        F.array(F.coalesce(F.col("group"), F.col("member"))),
        F.when(F.col("is_live"), F.array(F.lit(LIVE))).otherwise(empty),
        F.when(F.col("group").isNotNull() & ~F.col("is_live"), F.array(F.lit(PLAYLIST))).otherwise(empty),
    )
    data_pre = v.select("segment", "member", F.explode(pres).alias("pre"))
    return _roll_up(spark, data_pre, segments)


def _roll_up(spark: SparkSession, pre_rows: DataFrame, segments: list[C.SegmentConfig]) -> DataFrame:
    stages = F.broadcast(_stage_arrays(spark, segments))
    return pre_rows.join(stages, "segment", "inner").select(
        "segment", "member", "pre",
        F.explode(residual_target(F.col("pre"), F.col("stage_2"), F.col("stage_4"))).alias("feature"),
    )


def structural_catalog(spark: SparkSession, segments: list[C.SegmentConfig]) -> DataFrame:
    """(segment, feature) of the playlist-stage columns that exist by configuration alone,
    after the roll-up; depends on no data."""
    pre = _structural_playlist_features(spark, segments).select(
        "segment", F.lit(None).cast("string").alias("member"), "pre"
    )
    return _roll_up(spark, pre, segments).select("segment", "feature").distinct()


def playlist_rules(spark: SparkSession, block: DataFrame, segments: list[C.SegmentConfig],
                   learned: DataFrame | None = None) -> DataFrame:
    return playlist_rule_rows(spark, block, segments, learned).select("segment", "member", "feature")


def live_playlist_totals(spark: SparkSession, playlist_duration: DataFrame,
                         segments: list[C.SegmentConfig]) -> DataFrame:
    """(segment, gigya_id, live, playlist): the Live and Playlist totals per listener."""
    block = playlist_block(playlist_duration)
    first = F.broadcast(_first_groups(spark, segments))
    per_seg = block.join(first, "member", "inner")
    return per_seg.groupBy("segment", "gigya_id").agg(
        F.sum(F.when(F.col("is_live"), F.col("value")).otherwise(0.0)).alias("live"),
        F.sum(F.when(~F.col("is_live"), F.col("value")).otherwise(0.0)).alias("playlist"),
    )


def new_members(spark: SparkSession, playlist_duration: DataFrame, segments: list[C.SegmentConfig],
                prev: DataFrame | None = None, learned: DataFrame | None = None) -> DataFrame:
    """Map evolution report: playlists in this run's data that the previous run did not list, and
    whether the roll-up appends them to `Specials` (a `-M-` name outside the template)."""
    block = playlist_block(playlist_duration)
    vocab = _per_segment(block.select("member").distinct(), segments)
    if prev is None:
        prev = F.broadcast(C.previous_playlists(spark, segments))
    fresh = vocab.join(prev, ["segment", "member"], "left_anti")
    rows = playlist_rule_rows(spark, block, segments, learned)
    specials = (
        rows.where((F.col("feature") == SPECIALS) & (F.col("pre") != SPECIALS))
        .select("segment", "member", F.lit(True).alias("to_specials"))
        .distinct()
    )
    return fresh.join(specials, ["segment", "member"], "left").select(
        "segment", "member", F.coalesce("to_specials", F.lit(False)).alias("to_specials")
    )


# ---------------------------------------------------------------------------------------------
# Platform and listen type folds


def platform_rules(spark: SparkSession, block: DataFrame, segments: list[C.SegmentConfig],
                   default_platform: str) -> DataFrame:
    """A platform outside the template's stage_5 is folded into the default platform."""
    vocab = _per_segment(block.select("member").distinct(), segments)
    stages = F.broadcast(_stage_arrays(spark, segments))
    v = vocab.join(stages, "segment", "inner")
    feature = F.when(F.array_contains(F.col("stage_5"), F.col("member")), F.col("member")).otherwise(
        F.lit(default_platform)
    )
    return v.select("segment", "member", feature.alias("feature"))


def listen_type_rules(block: DataFrame, segments: list[C.SegmentConfig]) -> DataFrame:
    """Listen types are features as they are, except `newsflash`, which is added to Live."""
    vocab = _per_segment(block.select("member").distinct(), segments)
    feature = F.when(F.col("member") == NEWSFLASH, F.lit(LIVE)).otherwise(F.col("member"))
    return vocab.select("segment", "member", feature.alias("feature"))


def identity_rules(block: DataFrame, segments: list[C.SegmentConfig]) -> DataFrame:
    vocab = _per_segment(block.select("member").distinct(), segments)
    return vocab.select("segment", "member", F.col("member").alias("feature"))
