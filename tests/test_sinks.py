"""Parquet sinks of a run: model input, analytics, status and the weekly master facts."""

from listenscape.plans import pipeline
from listenscape.plans.demo import demo_config
from listenscape.sources import testdata


def test_write_outputs_and_master_facts(spark, tmp_path):
    cfg = demo_config()
    src = testdata.bind(spark, "/root/testdata/sf0.001")
    res = pipeline.run(spark, src, cfg)
    base = str(tmp_path / "out")
    pipeline.write_outputs(res, base, cfg.run_date, cfg.version)
    pipeline.write_outputs(res, base, "2024-02-05", cfg.version)
    pipeline.write_outputs(res, base, cfg.run_date, cfg.version)  # a rerun replaces its own partitions only
    assert spark.read.parquet(f"{base}/model_input").select("run_date").distinct().count() == 2
    assert spark.read.parquet(f"{base}/segment_status").select("run_date").distinct().count() == 2
    mi = spark.read.parquet(f"{base}/model_input")
    assert {"segment", "run_date", "gigya_id", "feature", "value"} <= set(mi.columns)
    assert mi.where(mi.run_date == cfg.run_date).count() == res.model_input.count()
    status = spark.read.parquet(f"{base}/segment_status")
    assert status.where("action = 'skip_segment'").where(status.run_date == cfg.run_date).count() == 1
    pipeline.write_master_facts(spark, src, base, cfg.run_date, cfg.version, cfg.main_segments())
    facts = spark.read.parquet(f"{base}/master_facts")
    got = {r["fact"] for r in facts.select("fact").distinct().collect()}
    assert got == {"total_duration", "podcast_duration", "playlist_duration", "listentype_duration",
                   "platform_duration", "age_duration", "gender_duration"}
    null_keys = {r["fact"] for r in facts.where("key IS NULL").select("fact").distinct().collect()}
    assert {"total_duration", "podcast_duration", "listentype_duration"} <= null_keys
    assert facts.where("fact = 'age_duration' AND key = 'u'").count() and facts.where("fact = 'gender_duration' AND key = 'u'").count()
    kept = spark.read.parquet(f"{base}/listeners")
    assert kept.where(kept.run_date == cfg.run_date).count() == res.n_kept
