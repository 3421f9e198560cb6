"""Channel blocks, the join for hot listeners, CSV markers and mapping documents on any file system."""

import json

import pytest
from pyspark.sql import functions as F

from listenscape.operators import channels, facts
from listenscape.plans import config as C
from listenscape.plans import registry
from listenscape.sources import files
from listenscape.sources.window import RunWindow


def test_channel_names(spark):
    names = {"Radio X Classic": "Radio X", "XTRA Reloaded": "Capital XTRA", "Heart 80s": "Heart 80s", "Heart Dance": "Heart Dance",
             "Capital DANCE": "Capital DANCE", "Gold 00s": "Gold 00s", "Smooth Radio London": "Smooth", "LBC": "LBC", "Test One": "Test",
             "Radio X 70s": "Radio X"}
    got = spark.createDataFrame([(n,) for n in names], "name string").select("name", channels.channel_name("name").alias("brand"))
    assert {r.name: r.brand for r in got.collect()} == names


def test_channel_listen_type_folds_drops_and_multiplies(spark):
    window = RunWindow.ending("2024-01-29")
    streams = spark.sql("""SELECT * FROM VALUES ('g1', 1L, 10L), ('g1', 1L, 5L), ('g1', 2L, 100L), ('g2', 1L, 7L), ('', 1L, 9L), ('g3', 9L, 3L),
        (NULL, 1L, 9L), ('g4', NULL, 8L) AS t(gigya_id, listener_id, duration)""").select(
        F.lit("s").alias("stream_id"), "gigya_id", "listener_id", F.lit("n").alias("stream_name"), F.lit("p").alias("platform"), "duration",
        F.to_timestamp(F.lit("2024-01-05 10:00:00")).alias("request_start"), F.to_timestamp(F.lit("2024-01-05 11:00:00")).alias("request_end"))
    plays = spark.sql("""SELECT listener_id, 1L AS episode_id, aod_type, DATE'2024-01-06' AS p_listen_date, channel_id FROM VALUES
        (1L, 'podcast', 1L), (1L, 'podcast', 1L), (1L, 'catchup', 2L), (1L, 'catchup', 3L), (1L, NULL, 1L), (1L, 'podcast', 4L),
        (2L, 'podcast', 1L), (2L, 'podcast', 8L), (2L, 'podcast', NULL) AS t(listener_id, aod_type, channel_id)""")
    dim = spark.createDataFrame([(1, "Heart London"), (2, "Radio X"), (3, "Test FM"), (4, None)], "id long, name string")
    got = channels.channel_listen_type(streams, plays, dim, window, ["Heart_podcast", "Global_podcast"])
    assert {(r.gigya_id, r.feature): r.value for r in got.collect()} == {
        ("g1", "Heart_podcast"): 2 * 15 + 100, ("g1", "Global_podcast"): 15, ("g2", "Heart_podcast"): 14, ("g2", "Global_podcast"): 7}


def test_fan_out_deals_a_hot_listener_over_tasks(spark):
    """One listener with 30 % of both sides, and rows without a listener: same rows as the plain join, even tasks."""
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    left = spark.range(40_000).select(
        F.concat(F.lit("g"), "id").alias("gigya_id"),
        F.when(F.col("id") % 10 < 3, F.lit(7)).when(F.col("id") % 10 == 3, F.lit(None)).otherwise(1000 + F.col("id") % 5000).cast("long").alias("listener_id"),
        (F.col("id") % 4 + 1).alias("n_streams"))
    right = spark.range(5000).select((1000 + F.col("id")).alias("listener_id"), F.lit("c0").alias("category"), F.lit(2).alias("listen_freq")).unionAll(
        spark.range(2143).select(F.lit(7).cast("long"), F.concat(F.lit("c"), F.col("id") % 3), F.lit(1)).distinct())
    plain = left.join(right, "listener_id", "left")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = facts.fan_out(left, right, rows=100)
        rows = sorted(r.n for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
        assert len(rows) >= 30 and rows[-1] <= 5 * rows[len(rows) // 2]
        assert max(r.n for r in plain.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()) > 5 * rows[len(rows) // 2]
        columns = ["gigya_id", "listener_id", "n_streams", "category", "listen_freq"]
        assert got.select(*columns).exceptAll(plain.select(*columns)).count() == 0 and got.count() == plain.count()
        assert sorted(map(tuple, facts.fan_out(left.limit(0), right).collect())) == []
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_csv_tells_null_empty_and_text_apart(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "NA"), (4, 'say "x", y'), (5, "two\nlines"), (6, " padded "), (None, "\\")]
    df = spark.createDataFrame(rows, "k long, v string")
    assert sorted(map(tuple, files.csv_roundtrip(spark, df, "markers").collect()), key=str) == sorted(rows, key=str)
    (tmp_path / "given.csv").write_text("id,name\n007,NA\n,x\n8,\n9,\"\"\nNA,NAN\n")
    given = files.read_csv(spark, str(tmp_path / "given.csv"), C.T.StructType.fromDDL("id string, name string"))
    assert [tuple(r) for r in given.collect()] == [("007", None), (None, "x"), ("8", None), ("9", None), (None, "NAN")]


def test_mapping_documents_by_uri(spark, tmp_path):
    root = tmp_path / "the maps"
    (root / "A").mkdir(parents=True)
    (root / "A" / "daypart_A.json").write_text(json.dumps({"NIGHT": [19, 23], "DAY": [6, 18]}))
    control = tmp_path / "control.json"
    control.write_text(json.dumps({"start_date": "2024-01-29", "segment": {"A": {"is_main": True}, "B": {}}}))
    cfg = C.load_run_config(f"file:{control}", f"file:{root}")
    assert list(cfg.segments[0].dayparts) == ["NIGHT", "DAY"] and cfg.segments[1].dayparts == {}
    with pytest.raises(ValueError):
        files.read_mapping_documents(spark, str(root), max_bytes=5)


def test_quantiles_of_a_single_listener(spark, monkeypatch):
    one = spark.createDataFrame([("g1", 5)], "gigya_id string, total_listen_time long")
    monkeypatch.setattr(facts, "total_duration", lambda *a, **k: one)
    assert tuple(registry.q_listen_quantiles(spark, "/root/testdata/sf0.001").first()) == (None, None, None)


def test_brand_rules_of_the_oracle_equal_the_expression(spark):
    import duckdb

    from listenscape.checks import oracle
    from listenscape.functions import expressions as X

    names = [f"{net}:{st}:{sub}" for net in ("Global", "Communicorp", "") for st in ("LBC", "Heart_North", "Radio_X", "Radio_X_Heart", "Capital", "")
             for sub in ("UK", "National", "LBC", "News", "Reloaded", "80s", "Chill", "East", "")] + ["Global", "Communicorp:LBC", "", None]
    want = {r.fqsn: r.brand for r in spark.createDataFrame([(n,) for n in names], "fqsn string").select("fqsn", X.station_brand().alias("brand")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE schedule AS SELECT 1 AS show_id, unnest($1) AS fqsn, TIMESTAMP '2024-01-05' AS show_start, "
                "TIMESTAMP '2024-01-05 01:00:00' AS show_end, 'x' AS show_long_name", [names])
    got = dict(con.execute(f"WITH {oracle.CTE_SCHEDULE} SELECT fqsn, brand FROM shows").fetchall())
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
