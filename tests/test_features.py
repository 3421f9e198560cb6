"""Golden cases for regrouping, roll-up, outliers, scaling, the gate, quantiles and the SVD."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from listenscape.operators import matrix, reduce, regroup, scaling
from listenscape.operators.quantiles import exact_quantiles
from listenscape.plans import config as C
from listenscape.plans.demo import demo_config


def _seg(**kw):
    base = dict(name="T", is_main=True, weights={"X_Group": 1.0}, dayparts={"ALL": (0, 23)},
                category_groups=["Car_Group", "News_Crime_Group"])
    base.update(kw)
    return C.SegmentConfig(**base)


def _block(spark, rows):
    return spark.createDataFrame(rows, "gigya_id string, member string, value double")


def test_category_groups_first_token_match(spark):
    seg = _seg()
    b = _block(spark, [("g", "Careers", 1.0), ("g", "True Crime", 2.0), ("g", "News", 3.0), ("g", "Music", 4.0)])
    rules = {r["member"]: r["feature"] for r in regroup.category_rules(spark, b, [seg]).collect()}
    # substring rule: `Car` matches `Careers`
    assert rules == {"Careers": "Car_Group", "True Crime": "News_Crime_Group", "News": "News_Crime_Group",
                     "Music": "Music"}


def test_playlist_regroup_rollup_and_totals(spark):
    seg = _seg(
        playlist_map={"Pop": ["Global-M-A", "Global-M-B"], "Rock": ["Global-M-B", "Global-M-C"], "Specials": [],
                      "Capital_Live_Stream": ["Capital_Live"], "Heart_Live_Stream": ["Heart_Live"],
                      "LBC_Live_Stream": ["LBC_Missing"]},
        live=["Capital_Live_Stream", "Heart_Live_Stream", "LBC_Live_Stream"],
        template={"stage_2": ["Pop", "Rock", "Specials", "Capital_Live_Stream", "LBC_Live_Stream", "Live",
                              "Playlist"],
                  "stage_4": ["Capital", "Heart", "LBC"]},
    )
    b = _block(spark, [("g", "Global-M-A", 1.0), ("g", "Global-M-B", 2.0), ("g", "Global-M-C", 4.0),
                       ("g", "Global-M-New", 8.0), ("g", "Capital_Live", 16.0), ("g", "Heart_Live", 32.0),
                       ("g", "Capital_Show", 64.0), ("g", "LBCNews_Show", 128.0), ("g", "Other", 256.0)])
    cells = regroup.rewrite(b, regroup.playlist_rules(spark, b, [seg]))
    got = {r["feature"]: r["v"] for r in cells.groupBy("feature").agg(F.sum("value").alias("v")).collect()}
    assert got["Pop"] == 3.0            # A + B (B goes to the first group listing it)
    assert got["Rock"] == 4.0           # C only
    assert got["Specials"] == 8.0       # a new -M- playlist is rolled into Specials
    assert got["Capital_Live_Stream"] == 16.0 + 64.0
    # Heart_Live_Stream is not in the template; it is not added to itself
    assert got["Heart_Live_Stream"] == 32.0
    assert got["LBC_Live_Stream"] == 128.0
    assert got["Live"] == 48.0          # live groups before the roll-up
    assert got["Playlist"] == 7.0
    assert got["Other"] == 256.0        # residual without a rule stays
    cat = {r["feature"] for r in regroup.structural_catalog(spark, [seg]).collect()}
    assert {"Pop", "Rock", "Capital_Live_Stream", "Heart_Live_Stream", "LBC_Live_Stream", "Live",
            "Playlist"} <= cat
    assert "Specials" not in cat        # empty list: a column only when something rolls into it


def test_outlier_cut_ties_and_quantiles(spark):
    vals = [10, 20, 30, 40, 1000, 1000]
    spine = spark.createDataFrame([(f"g{i}", v) for i, v in enumerate(vals)], "gigya_id string, total_listen_time long")
    rest = {r["gigya_id"] for r in matrix.drop_top_listener(spine).collect()}
    assert rest == {"g0", "g1", "g2", "g3", "g5"}   # the first id of the tie goes
    q1, q3 = matrix.listen_quantiles(spine)
    assert q1 == pytest.approx(np.quantile([10, 20, 30, 40, 1000], 0.25))
    assert q3 == pytest.approx(np.quantile([10, 20, 30, 40, 1000], 0.95))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(0, 50, 3000), np.full(2000, 17)])  # a third of the rows on one value
    df = spark.createDataFrame([(int(v),) for v in vals], "x long")
    probs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    got = exact_quantiles(df, "x", probs, buckets=8)
    assert got == pytest.approx([float(np.quantile(vals, p)) for p in probs])


def test_quantiles_and_cut_without_values(spark):
    none = spark.createDataFrame([], "gigya_id string, total_listen_time bigint")
    one = spark.createDataFrame([("a", 5)], none.schema)
    nulls = spark.createDataFrame([("a", None), ("b", None)], none.schema)
    assert exact_quantiles(none, "total_listen_time", [0.25, 0.95]) == [None, None]
    assert exact_quantiles(nulls, "total_listen_time", [0.5]) == [None]
    assert exact_quantiles(one, "total_listen_time", [0.25, 0.95]) == [5.0, 5.0]
    # the heaviest listener is taken out first, so one listener leaves no one
    assert matrix.outlier_cut(none).collect() == []
    assert matrix.outlier_cut(one).collect() == []


def test_stats_with_implicit_zeros_and_constant_scaling(spark):
    cells = spark.createDataFrame(
        [("T", "a", "f", 5.0), ("T", "b", "f", 5.0), ("T", "a", "k", 2.0), ("T", "b", "k", 2.0),
         ("T", "c", "k", 2.0)],
        "segment string, gigya_id string, feature string, value double")
    catalog = spark.createDataFrame([("T", "f"), ("T", "k"), ("T", "z")], "segment string, feature string")
    st = {r["feature"]: r for r in matrix.feature_stats(cells, catalog, 3).collect()}
    assert st["f"]["min"] == 0.0 and st["f"]["max"] == 5.0 and st["f"]["mean"] == pytest.approx(10 / 3)
    assert st["f"]["stddev"] == pytest.approx(np.std([5, 5, 0], ddof=1))
    assert st["k"]["min"] == 2.0 and st["k"]["stddev"] == 0.0
    assert st["z"]["max"] == 0.0
    weights = C.weights(spark, [_seg(weights={"k": 1.0})]).withColumn("segment", F.lit("T"))
    coef = scaling.coefficients(matrix.feature_stats(cells, catalog, 3), weights)
    norm = {(r["gigya_id"], r["feature"]): r["value"] for r in scaling.minmax_scale(cells, coef).collect()}
    assert norm[("a", "f")] == pytest.approx(100.0)
    assert norm[("a", "k")] == 0.0  # constant strong column -> 0


def test_signal_gate_missing_group_skips(spark):
    coef = spark.createDataFrame([("T", "x", 2, 0.0, 1.0, 0.0, 1.0, 0.0, 1.0, 100.0, 0.0, False)],
                                 "segment string, feature string, n long, min double, max double, gmin double, "
                                 "gmax double, min1 double, max1 double, scale double, shift double, strong boolean")
    norm = spark.createDataFrame([("T", "a", "x", 100.0)], "segment string, gigya_id string, feature string, value double")
    w = spark.createDataFrame([("T", "Missing_Group", 1.0, 0), ("T", "x_playlist", 1.0, 1)],
                              "segment string, feature string, weight double, weight_pos int")
    got = [tuple(r) for r in scaling.signal_gate(coef, norm, w).collect()]
    assert got == [("T", "Missing_Group", 0.0, "skip_segment")]


def test_svd_ratios_match_numpy():
    rng = np.random.default_rng(3)
    X = np.abs(rng.normal(size=(200, 12))) @ np.diag(np.linspace(5, 0.1, 12))
    names = [f"c{i}" for i in range(12)]
    b = reduce.choose_basis("T", names, X.shape[0], X.sum(0), X.T @ X, ladder=(2, 5, 10), target=0.9)
    _, s, vt = np.linalg.svd(X, full_matrices=False)
    proj = X @ vt.T
    ratios = proj.var(axis=0) / X.var(axis=0).sum()
    assert b.ratios == pytest.approx(list(ratios), abs=1e-6)
    for j in range(len(names)):
        assert abs(float(np.dot(b.vt[j] if j < (b.k or 0) else vt[j], vt[j]))) == pytest.approx(1.0, abs=1e-6) \
            if j < (b.k or 0) else True
    cum = np.cumsum(ratios)
    want = next((k for k in (2, 5, 10) if cum[k - 1] >= 0.9), None)
    assert b.k == want


def test_ladder_skips_rungs_above_column_count():
    X = np.eye(4)
    b = reduce.choose_basis("T", list("abcd"), 4, X.sum(0), X.T @ X)
    assert b.k is None  # the first rung (10) is above 4 columns


def test_pipeline_end_to_end(spark):
    from listenscape.plans import pipeline
    from listenscape.sources import testdata
    res = pipeline.run(spark, testdata.bind(spark, "/root/testdata/sf0.001"), demo_config())
    gate = {r["segment"]: r["action"] for r in res.gate.collect() if "Group" in r["feature"]}
    assert gate["B"] == "skip_segment"
    segs = {r["segment"] for r in res.model_input.select("segment").distinct().collect()}
    assert "B" not in segs
    norm = res.norm.agg(F.min("value"), F.max("value")).collect()[0]
    assert norm[0] >= -1e-9 and norm[1] <= 100 + 1e-9


def test_load_run_config(tmp_path):
    root = tmp_path / "maps"
    (root / "A").mkdir(parents=True)
    (root / "A" / "daypart_A.json").write_text(json.dumps({"DAY": [6, 18], "NIGHT": [19, 23]}))
    (root / "A" / "podcast_category_map_A.json").write_text(json.dumps({"News_Group": []}))
    (root / "A" / "A_template.JSON").write_text(json.dumps({"stage_2": ["Live"]}))
    control = tmp_path / "control.json"
    control.write_text(json.dumps({"start_date": "2024-01-29", "version": "v",
                                   "segment": {"A": {"is_main": True, "weight_dict": {"News_Group": 1}}}}))
    cfg = C.load_run_config(str(control), str(root))
    seg = cfg.main_segments()[0]
    assert list(seg.dayparts) == ["DAY", "NIGHT"]
    assert seg.template == {"stage_2": ["Live"]}     # extension matched without case
    assert seg.playlist_map == {}                    # absent playlist map -> empty
    (root / "A" / "daypart_A.json").write_text('{"DAY": [6]}')
    with pytest.raises(ValueError):
        C.load_run_config(str(control), str(root))
