"""Golden cases for the slot generator, brand rules, interval join, age bands and weekparts."""

import datetime as dt

from pyspark.sql import functions as F

from listenscape.functions import expressions as X
from listenscape.operators import slots
from listenscape.sources import schemas, testdata
from listenscape.sources.window import RunWindow

W = RunWindow.ending("2024-01-29")


def _streams(spark, rows):
    out = []
    for i, (start, duration, end) in enumerate(rows):
        out.append((str(i), "g1", 1, "S0", "web", duration, start, end))
    return spark.createDataFrame(out, schemas.STREAMS)


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_slot_counts_and_seconds(spark):
    base = _ts("2024-01-10 12:00:00")
    cases = [0, 1, 599, 600, 601, 1200, 300000, 400000]
    rows = [(base, d, base + dt.timedelta(seconds=d)) for d in cases]
    got = {
        r["stream_id"]: (r["n"], r["s"])
        for r in slots.listening_slots(_streams(spark, rows), W)
        .groupBy("stream_id").agg(F.count("*").alias("n"), F.sum("slot_seconds").alias("s")).collect()
    }
    # duration 0 gives no slot; 600 gives one; a long session keeps all its slots
    assert "0" not in got
    assert got["1"] == (1, 1)
    assert got["2"] == (1, 599)
    assert got["3"] == (1, 600)
    assert got["4"] == (2, 601)
    assert got["5"] == (2, 1200)
    assert got["6"] == (500, 300000)
    assert got["7"] == (667, 400000)


def test_slot_crossing_midnight_and_end_before_start(spark):
    start = _ts("2024-01-10 23:55:00")
    rows = [(start, 1200, start + dt.timedelta(seconds=1200)), (start, 600, start - dt.timedelta(seconds=10))]
    got = slots.listening_slots(_streams(spark, rows), W).orderBy("stream_id", "n").collect()
    assert [(r["stream_id"], r["n"], r["slot_seconds"]) for r in got] == [("0", 0, 600), ("0", 1, 600)]


def test_station_brand_rules(spark):
    cases = {
        "Global:Heart:80s": "Heart80s_Live",
        "Global:Capital_XTRA:Manchester": "CapitalXTRA_Manchester",
        "Global:Capital:UK": "Capital_Live",
        "Global:Capital:": "Capital_Live",
        "Communicorp:Heart_North:East": "Heart_regional",
        "Communicorp:Radio_X_Manc:North": "RadioX_Live",
        "Global:LBC:News": "LBCNews",
        "Communicorp:LBC:UK": "LBC",
        "Global:LBC:LBC": "LBC",
        "Global:Capital:Reloaded": "CapitalReloaded",
        "Communicorp:Smooth:National": "Smooth_National",
        "Global": "_Live",
        "Global:Gold": "Gold_Live",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "fqsn string")
    got = {r["fqsn"]: r["brand"] for r in df.select("fqsn", X.station_brand("fqsn").alias("brand")).collect()}
    for k, v in cases.items():
        assert got[k] == v, k
    assert got[None] is None


def test_interval_join_boundaries(spark):
    # two consecutive shows 10:00-13:00 and 13:00-16:00; a slot starting at 13:00 matches both
    show = [
        (1, "Global:Capital:UK", _ts("2024-01-10 10:00:00"), _ts("2024-01-10 13:00:00"), "A"),
        (2, "Global:Capital:UK", _ts("2024-01-10 13:00:00"), _ts("2024-01-10 16:00:00"), "B"),
        (3, "Global:Capital:UK", _ts("2024-01-10 22:00:00"), _ts("2024-01-11 01:00:00"), "Late"),
    ]
    sched = spark.createDataFrame(show, schemas.SCHEDULE)
    smap = spark.createDataFrame([("S0", "Capital_Live", "P0", "Capital")], schemas.STREAM_MAP)
    rows = [
        (_ts("2024-01-10 13:00:00"), 300, _ts("2024-01-10 13:05:00")),  # boundary: A and B
        (_ts("2024-01-10 10:00:00"), 300, _ts("2024-01-10 10:05:00")),  # show start: A
        (_ts("2024-01-11 00:30:00"), 300, _ts("2024-01-11 00:35:00")),  # after midnight: weekday differs
        (_ts("2024-01-12 10:00:00"), 300, _ts("2024-01-12 10:05:00")),  # no show that day
    ]
    st = _streams(spark, rows)
    got = sorted((r["slot_start"].hour, r["show_long_name"] or "") for r in slots.show_match(st, smap, sched, W).collect())
    assert got == sorted([(13, "A"), (13, "B"), (10, "A"), (0, ""), (10, "")])
    half = sorted((r["slot_start"].hour, r["show_long_name"] or "")
                  for r in slots.show_match(st, smap, sched, W, half_open=True).collect())
    assert (13, "A") not in half and (13, "B") in half
    pl = {r["playlist"]: r["total_duration"] for r in slots.playlist_duration(st, smap, sched, W).collect()}
    assert pl == {"Capital_A": 600, "Capital_B": 300, "Capital_Live": 600}


def test_open_ended_shows_meet_every_slot_of_their_weekday_in_few_buckets(spark):
    show = [(1, "Global:Capital:UK", _ts("2024-01-10 10:30:00"), _ts("9999-12-31 00:00:00"), "Open"),
            (2, "Global:Capital:UK", _ts("2024-01-28 23:00:00"), _ts("2024-02-20 00:00:00"), "Long")]
    sched = spark.createDataFrame(show, schemas.SCHEDULE)
    smap = spark.createDataFrame([("S0", "Capital_Live", "P0", "Capital")], schemas.STREAM_MAP)
    buckets = slots.bucketed_shows(smap, sched, W).groupBy("show_long_name").count().collect()
    assert {r["show_long_name"]: r["count"] for r in buckets} == {"Open": 14 + 24 + 24 + 1, "Long": 1 + 1}
    day = 86400
    rows = [(_ts("2024-01-10 10:20:00"), 300, _ts("2024-01-10 10:25:00")),   # before it begins
            (_ts("2024-01-17 03:00:00"), 300, _ts("2024-01-17 03:05:00")),   # a week later
            (_ts("2024-01-18 03:00:00"), 300, _ts("2024-01-18 03:05:00")),   # another weekday
            (_ts("2024-01-28 12:00:00"), 12 * day, _ts("2024-02-09 12:00:00"))]  # goes on far behind the window
    st = _streams(spark, rows)
    got = slots.show_match(st, smap, sched, W).collect()
    for r in got:
        t = r["slot_start"]
        want = ["Open"] if t.isoweekday() == 3 and t >= _ts("2024-01-10 10:30:00") else []
        want += ["Long"] if t.isoweekday() == 7 and t >= _ts("2024-01-28 23:00:00") else []
        assert (r["show_long_name"] or "") in (want or [""]), t
    assert sum(r["show_long_name"] == "Open" for r in got) == 1 + 2 * 144
    assert sum(r["show_long_name"] == "Long" for r in got) == 6 + 144


def test_shows_of_later_orders_match_slots(spark):
    t = testdata.bind(spark, "/root/testdata/sf0.01")
    shows = slots.bucketed_shows(t.stream_map, t.schedule, W)
    own = slots.show_match(t.streams, t.stream_map, t.schedule, W).where("brand_name LIKE 'Station%' AND tag = 1")
    assert shows.where("brand LIKE 'Station%'").select("brand").distinct().count() == 10
    assert own.select("brand_name").distinct().count() >= 8


def test_schedule_is_cut_to_carried_brands_before_it_is_expanded(spark):
    t = testdata.bind(spark, "/root/testdata/sf0.001")
    plan = slots.bucketed_shows(t.stream_map, t.schedule, W)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("LeftSemi")  # from the top down: the explode stands above


def test_names_are_derived_once_per_station_and_stream(spark):
    t = testdata.bind(spark, "/root/testdata/sf0.001")
    lines = slots.bucketed_shows(t.stream_map, t.schedule, W)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    rules = [k for k, line in enumerate(lines) if "Communicorp," in line or "= Communicorp" in line]
    distinct = next(k for k, line in enumerate(lines) if "Aggregate [fqsn" in line)
    assert rules and max(rules) <= distinct  # above the distinct names, on none of the schedule's rows


def test_playlist_seconds_need_one_exchange_by_listener(spark):
    t = testdata.bind(spark, "/root/testdata/sf0.001")
    plan = slots.playlist_duration(t.streams, t.stream_map, t.schedule, W)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(gigya_id") == 1
    assert "slot_start" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning(gigya_id" in x)


def test_age_bands(spark):
    ages = [14, 15, 19, 20, 24, 25, 34, 35, 44, 45, 54, 55, 59, 60, None]
    want = ["u", "15-19", "15-19", "20-24", "20-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54",
            "55-59", "55-59", "60+", "u"]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    assert [r[0] for r in df.select(X.age_band("a")).collect()] == want


def test_weekpart_boundaries(spark):
    ts = ["2024-01-12 23:59:59", "2024-01-13 00:00:00", "2024-01-14 23:59:59", "2024-01-15 00:00:00"]
    df = spark.createDataFrame([(_ts(t),) for t in ts], "t timestamp")
    assert [r[0] for r in df.select(X.weekpart("t")).collect()] == ["WEEKDAY", "WEEKEND", "WEEKEND", "WEEKDAY"]


def test_window_is_inclusive_of_end_midnight_only(spark):
    rows = [(_ts("2024-01-01 00:00:00"), 10, None), (_ts("2024-01-29 00:00:00"), 10, None),
            (_ts("2024-01-29 00:00:01"), 10, None), (_ts("2023-12-31 23:59:59"), 10, None)]
    st = _streams(spark, rows)
    assert sorted(r["stream_id"] for r in st.where(W.timestamps("request_start")).collect()) == ["0", "1"]
