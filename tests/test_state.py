"""State between weekly runs: two weeks, a rerun, an attempt without a commit."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from listenscape.plans import state
from listenscape.plans.demo import demo_config
from listenscape.sources import testdata

PLAYLISTS = "gigya_id string, playlist string, total_duration double"


def week(run_date):
    return dataclasses.replace(demo_config(), run_date=run_date)


def playlists(spark, *names):
    return spark.createDataFrame([("g1", n, 5.0) for n in names], PLAYLISTS)


def members(df):
    return {(r.segment, r.member) for r in df.collect()}


def step(spark, store, run_date, names, status=()):
    cfg, before = week(run_date), store.before(run_date)
    tables = state.evolve(spark, playlists(spark, *names), state.with_state(cfg, before), before)
    gate = spark.createDataFrame([(*s, run_date) for s in status], state.SCHEMAS["segment_status"])
    store.commit(run_date, "v", tables | {"segment_status": before["segment_status"].unionByName(gate)})
    return tables


def test_two_weeks_and_a_rerun(spark, tmp_path):
    store = state.StateStore(spark, str(tmp_path / "state"))
    first = store.before("2024-01-08")
    assert first.attempt is None
    assert ("A", "LBCNews") in members(state.previous(spark, week("2024-01-08"), first))
    step(spark, store, "2024-01-08", ["Global-M-New1", "Capital_Live"], [("B", "MISSING_Group", 0.0, "skip_segment"), ("D", "Quiet_playlist", 0.0, "remove_weight")])
    assert store.before("2024-01-08").attempt is None  # a rerun of this week sees no state

    second = store.before("2024-01-15")
    assert members(second["mapping_delta"]) == {(s, "Global-M-New1") for s in "ABD"}
    assert members(state.previous(spark, week("2024-01-15"), second)) == {(s, m) for s in "ABD" for m in ("Global-M-New1", "Capital_Live")}
    cfg = state.with_state(week("2024-01-15"), second)
    assert [s.name for s in cfg.main_segments()] == ["A", "D"]  # B was skipped
    assert "Quiet_playlist" in cfg.segments[3].weights  # weights come back with the control document
    assert "Quiet_playlist" not in state.with_state(week("2024-01-15"), second, keep_removed=True).segments[3].weights
    step(spark, store, "2024-01-15", ["Global-M-New1", "Global-M-New2"])
    third = store.before("2024-01-22")
    assert {(r.segment, r.member, r.first_run) for r in third["mapping_delta"].where("segment <> 'B'").collect()} == {
        (s, m, d) for s in "AD" for m, d in (("Global-M-New1", "2024-01-08"), ("Global-M-New2", "2024-01-15"))}
    assert ("B", "Capital_Live") in members(third["prev_playlists"])  # of its last run

    step(spark, store, "2024-01-15", ["Global-M-New3"])  # the rerun starts from the first week and replaces its attempt
    assert members(store.before("2024-01-22")["mapping_delta"].where("segment = 'A'")) == {("A", "Global-M-New1"), ("A", "Global-M-New3")}


def test_an_attempt_without_a_commit_is_not_read(spark, tmp_path):
    store = state.StateStore(spark, str(tmp_path / "state"))
    step(spark, store, "2024-01-08", ["Global-M-New1"])
    broken = spark.createDataFrame([("A",)], "segment string")
    with pytest.raises(Exception):
        store.commit("2024-01-15", "v", {n: broken for n in state.SCHEMAS})
    assert store.before("2024-01-22").run_date == "2024-01-08"


def test_learned_members_count_in_their_group(spark):
    from listenscape.operators import regroup
    block = regroup.playlist_block(playlists(spark, "Global-M-New1"))
    learned = spark.createDataFrame([("A", "Global-M-New1")], "segment string, member string")
    rules = {(r.segment, r.feature) for r in regroup.playlist_rules(spark, block, week("2024-01-08").main_segments(), learned).collect()}
    assert {("A", "Specials"), ("A", "Playlist")} <= rules
    assert ("D", "Playlist") not in rules and ("D", "Specials") in rules


def test_weekly_runs_on_the_tables(spark, tmp_path):
    store = state.StateStore(spark, str(tmp_path / "state"))
    results = {}
    for run_date in ("2024-01-22", "2024-01-29"):
        src = testdata.bind(spark, "/root/testdata/sf0.001", run_date)
        res = state.run_week(spark, src, week(run_date), store)
        results[run_date] = {r.segment for r in res.gate.collect()}
    assert results == {"2024-01-22": {"A", "B", "D"}, "2024-01-29": {"A", "D"}}
    after = store.before("2024-02-05")
    status = {(r.segment, r.action, r.run_date) for r in after["segment_status"].where(F.col("action") != "keep").collect()}
    assert ("B", "skip_segment", "2024-01-22") in status and ("D", "remove_weight", "2024-01-29") in status
