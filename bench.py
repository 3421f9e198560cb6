"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Queries: playlist_duration (slots + interval join), category_weighted (fan-out join),
feature_matrix (all blocks, all segments) and the full weekly pipeline (facts -> outlier cut ->
scaling -> gate -> SVD -> model input). One warm-up, then $BENCH_RUNS measured runs; the median
of each is reported. Every DataFrame is executed completely through the `noop` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from listenscape.plans import pipeline, registry  # noqa: E402
from listenscape.plans.demo import demo_config  # noqa: E402
from listenscape.session import local_session  # noqa: E402
from listenscape.sources import testdata  # noqa: E402


def run_df(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def full_pipeline(spark, sf_dir) -> None:
    res = pipeline.run(spark, testdata.bind(spark, sf_dir), demo_config())
    run_df(res.model_input)
    run_df(res.norm)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    jobs = {
        "playlist_duration": lambda: run_df(registry.q_playlist_duration(spark, sf_dir)),
        "category_weighted": lambda: run_df(registry.q_category_weighted(spark, sf_dir)),
        "feature_matrix": lambda: run_df(registry.q_feature_matrix(spark, sf_dir)),
        "full_pipeline": lambda: full_pipeline(spark, sf_dir),
    }
    times: dict[str, list[float]] = {k: [] for k in jobs}
    for i in range(runs + 1):
        for name, job in jobs.items():
            t0 = time.perf_counter()
            job()
            dt = time.perf_counter() - t0
            if i > 0:
                times[name].append(dt)
            spark.catalog.clearCache()
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "median_seconds_total",
        "value": round(sum(med.values()), 3),
        "unit": "sec",
        "queries": med,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "runs": runs,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
