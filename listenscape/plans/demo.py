"""The small configuration the registered queries and the tests run with.

It follows FIXTURES.md section 3: two main segments with different daypart maps (B's overlap at
hour 21), podcast-category groups that exercise the substring rule, a playlist map with a shared
member, an empty group and a group whose only member is absent, and a template that leaves out
one live-stream group. Segment C is configured but not main; D passes the gate and loses a weight.
"""

from __future__ import annotations

from listenscape.plans.config import RunConfig, SegmentConfig
from listenscape.sources.window import TEST_RUN_DATE

# Test dayparts of uneven length: A leaves hour 13 out, B puts hours 20 and 21 in two dayparts.
DAYPARTS_A = {
    "DAWN": (4, 6),
    "FORENOON": (7, 12),
    "TEATIME": (14, 17),
    "DUSK": (18, 22),
    "NIGHT": (23, 23),
    "SMALL_HOURS": (0, 3),
}
DAYPARTS_B = {
    "SMALL_HOURS": (0, 5),
    "DAY": (6, 16),
    "DUSK": (17, 21),
    "NIGHT": (20, 23),
}
CATEGORY_GROUPS = ["ECON_PROMO_Group", "SMALL_MED_Group", "LARGE_Brand#1_Group"]
PLAYLIST_MAP = {
    "Seasonal": ["Global-M-Mix3", "Global-M-Mix8"],
    "Pop": ["Global-M-Mix8", "Global-M-Mix13"],
    "Specials": [],
    "Capital_Live_Stream": ["Capital_Live"],
    "RadioX_Live_Stream": ["RadioX_Live"],
    "Heart_Live_Stream": ["Heart_regional"],
    "LBC_Live_Stream": ["LBC_Live"],
}
LIVE = ["Capital_Live_Stream", "RadioX_Live_Stream", "Heart_Live_Stream", "LBC_Live_Stream"]
PREV_PLAYLISTS = ["Capital_Live", "Heart_regional", "RadioX_Live", "LBCNews", "Global-M-Mix3",
                  "Global-M-Mix8", "Global-M-Mix13"]

#: Columns, strong and weak, whose values the keys ``signed_*`` negate: their absent cells do not map to 0.
SIGNED = ("DAY_WEEKDAY", "ECON_PROMO_Group", "NIGHT_WEEKEND", "DUSK_WEEKEND", "podcast")


def _template(dayparts: dict) -> dict[str, list[str]]:
    return {
        "stage_1": ["Unknown"] + CATEGORY_GROUPS,
        "stage_2": [g for g in PLAYLIST_MAP if g != "RadioX_Live_Stream"] + ["Live", "Playlist"],
        "stage_3": ["catchup", "podcast", "newsflash"],
        "stage_4": ["Capital", "RadioX", "Heart", "LBC"],
        "stage_5": ["click", "view", "purchase"],
        "stage_6": [f"{d}_{w}" for d in dayparts for w in ("WEEKDAY", "WEEKEND")],
    }


def _segment(name: str, is_main: bool, weights: dict, dayparts: dict, more_groups: dict | None = None) -> SegmentConfig:
    return SegmentConfig(
        name=name,
        is_main=is_main,
        weights=weights,
        dayparts=dict(dayparts),
        category_groups=list(CATEGORY_GROUPS),
        playlist_map={k: list(v) for k, v in (PLAYLIST_MAP | (more_groups or {})).items()},
        live=list(LIVE),
        prev_playlists=list(PREV_PLAYLISTS),
        template=_template(dayparts),
    )


def demo_config() -> RunConfig:
    segments = [
        _segment("A", True, {"ECON_PROMO_Group": 1.0, "Pop": 0.5, "25-34": 0.5}, DAYPARTS_A),
        _segment("B", True, {"MISSING_Group": 1.0, "Seasonal_playlist": 0.5, "NIGHT_WEEKEND": 0.5}, DAYPARTS_B),
        _segment("C", False, {"SMALL_MED_Group": 1.0}, DAYPARTS_A),
        # Passes the gate, and loses the weight of a playlist group that nobody plays.
        _segment("D", True, {"LARGE_Brand#1_Group": 1.0, "Quiet_playlist": 0.5, "DAY_WEEKDAY": 0.5}, DAYPARTS_B, {"Quiet_playlist": ["Silent_Stream"]}),
    ]
    for s in segments:
        s.validate()
    # The bindings use event types as platforms, so the fold target is one of them.
    return RunConfig(segments=segments, run_date=TEST_RUN_DATE, version="test", default_platform="view")


#: The channel and listen type columns that `channel_listen_type` keeps apart; all others are summed.
CHANNEL_LISTEN_TYPES = [
    "Global_podcast", "Radio X_catchup", "Radio X_podcast", "Capital XTRA_podcast", "Heart 70s BRAZIL_podcast",
    "Capital DANCE EGYPT_catchup", "FRANCE_podcast", "SAUDI_catchup", "UNITED_newsflash",
]
