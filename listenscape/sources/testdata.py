"""Binding of the listening sources to the generated test tables.

The rules are the ones in FIXTURES.md section 2; the DuckDB oracle (``listenscape.checks.oracle``)
states the same rules in SQL, so both engines read identical rows. Every binding is a projection
(plus a filter) of one generated table, so it scales with that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenscape.sources.tables import Sources
from listenscape.sources.window import TEST_RUN_DATE, RunWindow

# Fixed values of the bindings (FIXTURES.md section 2).
FIXED_DAY0 = "2024-01-01"
FIXED_SCHEDULE_EPOCH0 = 1704067200  # 2024-01-01 00:00:00 UTC
FIXED_SCHEDULE_FQSN = [
    "Global:Capital:UK",
    "Communicorp:Heart_North:East",
    "Global:Radio_X:",
    "Global:LBC:News",
    "Global:Heart:80s",
    "Global:Capital:Reloaded",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _ts(c: Column) -> Column:
    # Test Parquet stores TIMESTAMP_NTZ; the library works in session-UTC timestamps.
    return c.cast("timestamp")


def streams(spark: SparkSession, sf_dir: str, window: RunWindow | None = None) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    if window is not None:
        # Coarse predicate on the raw column so the Parquet scan can skip row groups; the exact
        # window filter is applied by the operators on request_start.
        ev = ev.where(
            (F.col("ts") >= F.to_timestamp_ntz(F.lit(f"{window.start_iso} 00:00:00")))
            & (F.col("ts") < F.to_timestamp_ntz(F.lit(f"{window.end_iso} 00:00:01")))
        )
    eid = F.col("event_id")
    start = F.date_trunc("second", _ts(F.col("ts")))
    duration = F.round(F.col("value") * 60).cast("bigint")
    return ev.select(
        _s(eid).alias("stream_id"),
        F.when(eid % 97 == 0, F.lit(""))
        .when(eid % 89 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("g"), _s(F.col("user_id"))))
        .alias("gigya_id"),
        (F.col("user_id") * 2 + eid % 2).alias("listener_id"),
        # A third of the streams belongs to the stations of the later orders; both grow with the tables.
        F.when(eid % 3 == 0, F.concat(F.lit("T"), _s(F.floor(eid / 900) + 1))).otherwise(F.concat(F.lit("S"), _s(eid % 27))).alias("stream_name"),
        F.col("event_type").alias("platform"),
        duration.alias("duration"),
        start.alias("request_start"),
        F.timestamp_seconds(F.unix_timestamp(start) + duration).alias("request_end"),
    )


def on_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return li.select(
        (F.col("l_partkey") % 400).alias("listener_id"),
        # Every part has categories, so some plays name episodes that no part has.
        F.when(F.col("l_orderkey") % 17 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("episode_id"),
        F.when(flag == "A", "catchup")
        .when(flag == "N", "podcast")
        .when((flag == "R") & (status == "O"), "newsflash")
        .alias("aod_type"),
        F.date_add(F.lit(FIXED_DAY0).cast("date"), (F.col("l_orderkey") % 35).cast("int")).alias("p_listen_date"),
        # Channels 25 to 28 have no name; some plays have no channel.
        F.when(F.col("l_linenumber") < 7, F.col("l_suppkey") % 29).cast("bigint").alias("channel_id"),
    )


def episode_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    by_type = part.select(
        F.col("p_partkey").alias("episodeid"), F.col("p_type").alias("category")
    )
    by_brand = part.where(F.col("p_partkey") % 10 == 0).select(
        F.col("p_partkey").alias("episodeid"), F.col("p_brand").alias("category")
    )
    return by_type.unionByName(by_brand)


def consent(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _table(spark, sf_dir, "customer")
    rows = cust.select(
        F.concat(F.lit("g"), _s(F.col("c_custkey"))).alias("gigya_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "refused").otherwise("tcf:consent_given:v2").alias("consent_status"),
        F.col("c_custkey"),
    )
    dup = rows.where(F.col("c_custkey") % 25 == 0)
    return rows.unionByName(dup).drop("c_custkey")


def stream_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nat = _table(spark, sf_dir, "nation")
    n = F.col("n_nationkey")
    k = n % 5
    pruned = F.when(k == 0, "Capital_Live").when(k == 1, "Heart_regional").when(k == 2, "RadioX_Live")
    pruned = pruned.when(k == 3, F.concat(F.lit("Global-M-Mix"), _s(n))).otherwise("LBCNews")
    channel = F.when(k == 0, "Capital").when(k == 1, "Heart").when(k == 2, "RadioX").when(k == 3, "Global")
    channel = channel.otherwise("LBC")
    fixed = nat.select(
        F.concat(F.lit("S"), _s(n)).alias("stream_name"),
        pruned.alias("playlist_pruned"),
        F.when(k == 1, "regional").otherwise(F.concat(F.lit("P"), _s(n))).alias("playlist"),
        channel.alias("channel"),
    )
    # A stream for every station that the later orders make, so that their shows can be matched too.
    station = F.floor(F.col("o_orderkey") / 1392)
    own = _table(spark, sf_dir, "orders").where(F.col("o_orderkey") >= 1392).select(_s(station).alias("k")).distinct()
    return fixed.unionByName(own.select(
        F.concat(F.lit("T"), "k").alias("stream_name"), F.concat(F.lit("Station"), "k", F.lit("_Live")).alias("playlist_pruned"),
        F.concat(F.lit("Q"), "k").alias("playlist"), F.lit("Station").alias("channel")))


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    # One block of 1392 shows fills six stations for 29 days; later blocks belong to stations of their own,
    # so the schedule grows with the orders and the shows per slot do not.
    first = F.element_at(F.array(*[F.lit(v) for v in FIXED_SCHEDULE_FQSN]), (ok % 6 + 1).cast("int"))
    own = F.concat(F.lit("Global:Station"), _s(F.floor(ok / 1392)), F.lit(":UK"))
    fqsn = F.when(ok >= 1392, own).otherwise(first)
    start = (
        F.lit(FIXED_SCHEDULE_EPOCH0)
        + F.lit(10800) * (F.floor(ok / 6) % 8)
        + F.lit(86400) * (F.floor(ok / 48) % 29)
    )
    return orders.select(
        ok.alias("show_id"),
        fqsn.alias("fqsn"),
        F.timestamp_seconds(start).alias("show_start"),
        F.timestamp_seconds(start + 10800).alias("show_end"),
        F.concat(F.lit("Show "), _s(F.col("o_custkey") % 7)).alias("show_long_name"),
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    g = F.col("c_nationkey") % 3
    return cust.select(
        F.concat(F.lit("g"), _s(key)).alias("pers_id"),
        F.when(key % 13 == 0, F.lit(None)).otherwise(10 + key % 60).cast("int").alias("pers_age"),
        F.when(g == 0, "m").when(g == 1, "f").alias("pers_gender"),
        F.timestamp_seconds(F.lit(FIXED_SCHEDULE_EPOCH0) + (key % 35) * 86400).alias("request_start"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = _table(spark, sf_dir, "embeddings")
    return emb.select(
        F.concat(F.lit("g"), _s(F.col("vec_id"))).alias("gigya_id"),
        F.concat(F.lit("Cluster "), _s(F.col("label"))).alias("PREDICTION"),
        F.lit("APPROVED").alias("DEPLOYMENT_APPROVAL_STATUS"),
        (F.col("label") / 10.0).alias("Cluster 1_PREDICTION"),
        (1.0 - F.col("label") / 10.0).alias("Cluster 2_PREDICTION"),
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel dimension for the channel blocks: one row per nation, ids 0..24, with names of every kind."""
    nat = _table(spark, sf_dir, "nation")
    kind, name = F.col("n_nationkey") % 8, F.col("n_name")
    return nat.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.when(kind == 0, F.concat(F.lit("Radio X "), name)).when(kind == 1, F.concat(F.lit("Capital XTRA "), name))
        .when(kind == 2, F.concat(F.lit("Heart 70s "), name)).when(kind == 3, F.concat(F.lit("Test "), name))
        .when(kind == 4, F.concat(F.lit("Capital DANCE "), name)).when(kind == 5, F.concat(name, F.lit(" FM"))).otherwise(name).alias("name"))


def bind(spark: SparkSession, sf_dir: str, run_date: str = TEST_RUN_DATE) -> Sources:
    window = RunWindow.ending(run_date)
    return Sources(
        streams=streams(spark, sf_dir, window),
        on_demand=on_demand(spark, sf_dir),
        consent=consent(spark, sf_dir),
        episode_category=episode_category(spark, sf_dir),
        stream_map=stream_map(spark, sf_dir),
        schedule=schedule(spark, sf_dir),
        demographics=demographics(spark, sf_dir),
        window=window,
        extra={"channels": channels(spark, sf_dir)},
    )
