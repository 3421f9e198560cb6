"""Column expressions shared by the operators. All JVM-side; no Python UDF anywhere.

Each function returns a ``Column`` so it can be inlined into a projection and stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOT_SECONDS = 600

# Fixed values of the station-name rules (order matters, first match wins).
FIXED_BRAND_LIVE_SUFFIX_PARTS = ["00s", "90s", "70s", "80s", "Country", "Dance", "Chill", ""]
FIXED_BRAND_NATIONAL_PARTS = ["UK", "National", ""]
FIXED_BRAND_EXCLUDED_PARTS = FIXED_BRAND_LIVE_SUFFIX_PARTS + ["UK", "National", "LBC", "News", "Reloaded"]
FIXED_REGIONAL_NETWORK = "Communicorp"

# Fixed age bands, first match wins; anything else (NULL, under 15) is 'u'.
FIXED_AGE_BANDS = [
    ("25-34", 25, 34),
    ("35-44", 35, 44),
    ("45-54", 45, 54),
    ("15-19", 15, 19),
    ("20-24", 20, 24),
    ("55-59", 55, 59),
]
FIXED_AGE_TOP = ("60+", 59)  # strictly above 59
UNKNOWN = "u"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_empty_id(c: str | Column = "gigya_id") -> Column:
    """`id NOT LIKE ''`: drops '' and, by three-valued logic, NULL."""
    return col(c) != F.lit("")


def consent_given(c: str | Column = "consent_status") -> Column:
    return col(c).like("%consent_given%")


def part(c: str | Column, delim: str, k: int) -> Column:
    """1-based SPLIT_PART; '' when the part does not exist, NULL only for a NULL input."""
    return F.split_part(col(c), F.lit(delim), F.lit(k))


def station_brand(fqsn: str | Column = "fqsn") -> Column:
    """Brand of a schedule row from its `network:brand:station` name (nine ordered rules)."""
    p1, p2, p3 = part(fqsn, ":", 1), part(fqsn, ":", 2), part(fqsn, ":", 3)
    regional = p1 == F.lit(FIXED_REGIONAL_NETWORK)
    p2_plain = F.replace(p2, F.lit("_"), F.lit(""))
    return (
        F.when(~regional & p3.isin(*FIXED_BRAND_LIVE_SUFFIX_PARTS), F.concat(p2_plain, p3, F.lit("_Live")))
        .when(~regional & ~p3.isin(*FIXED_BRAND_EXCLUDED_PARTS), F.concat(p2_plain, F.lit("_"), p3))
        .when(~regional & p3.isin(*FIXED_BRAND_NATIONAL_PARTS), F.concat(p2_plain, F.lit("_Live")))
        .when(regional & p2.like("%Heart%"), F.lit("Heart_regional"))
        .when(regional & p2.like("%Radio_X%"), F.lit("RadioX_Live"))
        .when((p2 == "LBC") & (p3 == "News"), F.lit("LBCNews"))
        .when((p2 == "LBC") & p3.isin("UK", "LBC"), F.lit("LBC"))
        .when(p3 == "Reloaded", F.concat(p2_plain, F.lit("Reloaded")))
        .otherwise(F.concat(p2, F.lit("_"), p3))
    )


def stream_brand(pruned: str | Column = "playlist_pruned", channel: str | Column = "channel",
                 playlist: str | Column = "playlist") -> Column:
    """Brand a stream is scheduled under: live streams by name, regional ones by channel."""
    p = col(pruned)
    return (
        F.when(p.like("%Live%"), p)
        .when(p.like("%regional%"), F.concat(col(channel), F.lit("_"), col(playlist)))
        .otherwise(p)
    )


def earlier(a: str | Column, b: str | Column) -> Column:
    """CASE WHEN a < b THEN a ELSE b: a NULL comparison yields b."""
    return F.when(col(a) < col(b), col(a)).otherwise(col(b))


def plus_seconds(ts: str | Column, seconds: Column | int) -> Column:
    """Timestamp shifted by a whole number of seconds, keeping sub-second precision."""
    s = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_micros(F.unix_micros(col(ts)) + s.cast("bigint") * 1_000_000)


def clock_seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second clock-time difference end - start, wrapping over midnight (+86400 if negative)."""
    d = F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))
    d = (d % 86400 + 86400) % 86400
    return d


def age_band(age: str | Column = "pers_age") -> Column:
    a = col(age)
    expr = None
    for name, lo, hi in FIXED_AGE_BANDS:
        cond = (a >= lo) & (a <= hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    top_name, top_from = FIXED_AGE_TOP
    return expr.when(a > top_from, F.lit(top_name)).otherwise(F.lit(UNKNOWN))


def gender(g: str | Column = "pers_gender") -> Column:
    return F.coalesce(col(g), F.lit(UNKNOWN))


def weekpart(ts: str | Column) -> Column:
    """WEEKEND for Saturday and Sunday, WEEKDAY otherwise (dayofweek: 1 = Sunday, 7 = Saturday)."""
    d = F.dayofweek(col(ts))
    return F.when(d.isin(1, 7), F.lit("WEEKEND")).otherwise(F.lit("WEEKDAY"))
