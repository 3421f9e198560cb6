"""State that one weekly run leaves to the next (F16, S11), as versioned tables.

    <base>/<table>/run_date=.../attempt=.../     data of one attempt of one run, written first
    <base>/commits/                              one row per attempt, appended when all its tables are there

A run reads the state of the last committed run *before* its own date, so a rerun of a week sees what its first
attempt saw, and replaces that attempt for the weeks after it. Tables of an attempt without a commit row are never
read. Tables:

- ``prev_playlists`` (segment, member): the playlists of the run, with which the next run finds new ones;
- ``mapping_delta`` (segment, member, group, first_run): ``-M-`` playlists outside the template, which the
  run appends to ``Specials``; from the next run on they are members of that group, and so count in ``Playlist`` too;
- ``segment_status`` (segment, feature, total, action, run_date): the signal gate's results. A skipped segment
  does not run again. A removed weight is recorded; the weights themselves come from the control
  document every week, unless ``keep_removed`` is set.
"""

from __future__ import annotations

import dataclasses
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenscape.operators import regroup, slots
from listenscape.plans import config as C
from listenscape.plans import pipeline
from listenscape.sources.tables import Sources

SCHEMAS = {
    "prev_playlists": "segment string, member string",
    "mapping_delta": "segment string, member string, group string, first_run string",
    "segment_status": "segment string, feature string, total double, action string, run_date string",
}
COMMIT = "run_date string, version string, attempt string, committed_at timestamp"


@dataclass
class State:
    """What the last committed run left; no run (``attempt`` None) leaves empty tables."""

    run_date: str | None
    attempt: str | None
    tables: dict[str, DataFrame]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


class StateStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def commits(self) -> DataFrame:
        """All commit rows; a few per run."""
        path = f"{self.base}/commits"
        if not self._exists(path):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).parquet(path)

    def before(self, run_date: str) -> State:
        """The state of the last committed run with an earlier date, by its last attempt."""
        last = (self.commits().where(F.col("run_date") < run_date)
                .orderBy(F.col("run_date").desc(), F.col("committed_at").desc()).limit(1).collect())
        if not last:
            return State(None, None, {n: self.spark.createDataFrame([], s) for n, s in SCHEMAS.items()})
        run, attempt = last[0]["run_date"], last[0]["attempt"]
        return State(run, attempt, {n: self.spark.read.schema(s).parquet(self._path(n, run, attempt)) for n, s in SCHEMAS.items()})

    def _path(self, table: str, run_date: str, attempt: str) -> str:
        return f"{self.base}/{table}/run_date={run_date}/attempt={attempt}"

    def commit(self, run_date: str, version: str, tables: dict[str, DataFrame]) -> str:
        """Write all tables, then the row that makes them visible."""
        attempt = uuid.uuid4().hex
        for name, schema in SCHEMAS.items():
            tables[name].select(*[c.split()[0] for c in schema.split(", ")]).write.parquet(self._path(name, run_date, attempt))
        row = self.spark.createDataFrame([(run_date, version, attempt)], "run_date string, version string, attempt string")
        row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.base}/commits")
        return attempt


def with_state(cfg: C.RunConfig, state: State, keep_removed: bool = False) -> C.RunConfig:
    """The configuration without the segments that were skipped before; reads a row per segment at most."""
    rows = state["segment_status"].where("action <> 'keep'").select("segment", "feature", "action").distinct().collect()
    skipped = {r["segment"] for r in rows if r["action"] == "skip_segment"}
    removed = {(r["segment"], r["feature"]) for r in rows if r["action"] == "remove_weight" and keep_removed}
    segments = [dataclasses.replace(s, is_main=s.is_main and s.name not in skipped,
                                    weights={f: w for f, w in s.weights.items() if (s.name, f) not in removed}) for s in cfg.segments]
    return dataclasses.replace(cfg, segments=segments)


def previous(spark: SparkSession, cfg: C.RunConfig, state: State) -> DataFrame:
    """(segment, member) the playlists to compare with: the last run's, before any run the mapping documents'."""
    if state.attempt is None:
        return C.previous_playlists(spark, cfg.main_segments())
    return state["prev_playlists"]


def evolve(spark: SparkSession, playlist_duration: DataFrame, cfg: C.RunConfig, state: State) -> dict[str, DataFrame]:
    """``prev_playlists`` and ``mapping_delta`` after a run with these playlists."""
    segments = cfg.main_segments()
    block = regroup.playlist_block(playlist_duration).select("member").distinct().cache()
    learned = state["mapping_delta"]
    rows = regroup.playlist_rule_rows(spark, block, segments, learned)
    fresh = (rows.where((F.col("feature") == regroup.SPECIALS) & (F.col("pre") != regroup.SPECIALS))
             .select("segment", F.col("pre").alias("member"), F.lit(regroup.SPECIALS).alias("group"), F.lit(cfg.run_date).alias("first_run")).distinct())
    names = [s.name for s in segments]
    others = state["prev_playlists"].where(~F.col("segment").isin(names))  # segments that did not run keep theirs
    now = block.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("segment"), "member")
    return {"prev_playlists": now.unionByName(others),
            "mapping_delta": learned.unionByName(fresh.join(learned, ["segment", "member"], "left_anti").select("segment", "member", "group", "first_run"))}


def run_week(spark: SparkSession, src: Sources, cfg: C.RunConfig, store: StateStore, keep_removed: bool = False) -> pipeline.RunResult:
    """One weekly run on the state before it; commits the state after it."""
    state = store.before(cfg.run_date)
    cfg = with_state(cfg, state, keep_removed)
    res = pipeline.run(spark, src, cfg, learned=state["mapping_delta"])
    playlists = slots.playlist_duration(src.streams, src.stream_map, src.schedule, src.window)
    tables = evolve(spark, playlists, cfg, state)
    tables["segment_status"] = state["segment_status"].unionByName(res.gate.withColumn("run_date", F.lit(cfg.run_date)).select(
        "segment", "feature", "total", "action", "run_date"))
    store.commit(cfg.run_date, cfg.version, tables)
    return res
