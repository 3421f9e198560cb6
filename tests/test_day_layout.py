"""Sources in day folders: the run window reaches the scan as a partition predicate."""

import re

from pyspark.sql import functions as F

from listenscape.operators import facts
from listenscape.sources import schemas, tables, testdata
from listenscape.sources.window import RunWindow


def test_day_folders_are_pruned_and_give_the_same_facts(spark, tmp_path):
    window = RunWindow.ending("2024-01-15", weeks=1)
    src = testdata.bind(spark, "/root/testdata/sf0.001")
    streams = src.streams.unionByName(src.streams.limit(3).withColumn("request_start", F.lit(None).cast("timestamp")))
    frames = {"streams": streams, **{n: getattr(src, n) for n in schemas.ALL if n != "streams"}}
    paths = {n: str(tmp_path / n) for n in frames}
    for name, df in frames.items():
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.ALL[name].fields])
        if name in tables.DAY_OF:
            tables.write_by_day(rows, paths[name], name)
            tables.write_by_day(rows, paths[name], name)  # the same days again are replaced
        else:
            rows.write.parquet(paths[name])
    got = tables.read_sources(spark, paths, window, by_day=tables.DAY_OF)
    for name in tables.DAY_OF:
        plan = getattr(got, name)._jdf.queryExecution().executedPlan().toString()
        (predicate,) = re.findall(r"PartitionFilters: \[(.*?)\]", plan)
        assert "day" in predicate and "2024-01-07" in predicate and "2024-01-16" in predicate
    days = {re.search("day=([^/]*)/", r.f)[1] for r in got.streams.select(F.input_file_name().alias("f")).distinct().collect()}
    assert days <= {f"2024-01-{d:02}" for d in range(7, 17)} and len(days) == 10
    assert got.streams.columns == [f.name for f in schemas.STREAMS.fields]

    def rows(s, fact):
        return sorted(map(str, fact(s).collect()))

    src.streams = streams
    for fact in (lambda s: facts.scan_streams(s.streams, window), lambda s: facts.category_weighted(s.streams, s.on_demand, s.episode_category, window),
                 lambda s: facts.age_band(s.demographics, window), lambda s: facts.total_duration(s.streams, s.consent, window)):
        assert rows(got, fact) == rows(src, fact) != []
