"""Images of absent cells, the distributed Gram matrix, the ladder and projections, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from listenscape.operators import matrix, reduce, scaling

CELL = "segment string, gigya_id string, feature string, value double"


def stats_row(feature, low, high, strong=False, n=3):
    return ("T", feature, n, low, high, strong)


def coefficients(spark, rows):
    stats = spark.createDataFrame([r[:5] for r in rows], "segment string, feature string, n long, min double, max double")
    weights = spark.createDataFrame([(r[0], r[1], 1.0, k) for k, r in enumerate(rows) if r[5]] or [("T", "none", 1.0, 0)],
                                    "segment string, feature string, weight double, weight_pos int")
    return scaling.coefficients(stats, weights)


def test_absent_cells_of_negative_columns_have_images(spark):
    cells = spark.createDataFrame([("T", "a", "f", -5.0), ("T", "b", "f", 10.0), ("T", "a", "g", 4.0)], CELL)
    rows = spark.createDataFrame([("T", x) for x in "abc"], "segment string, gigya_id string")
    coef = coefficients(spark, [stats_row("f", -5.0, 10.0), stats_row("g", 0.0, 4.0)])
    got = {(r.gigya_id, r.feature): r.value for r in scaling.minmax_scale(cells, coef, rows).collect()}
    assert got == pytest.approx({("a", "f"): 0.0, ("b", "f"): 100.0, ("c", "f"): 100 / 3, ("a", "g"): 100.0})
    assert ("c", "f") not in {(r.gigya_id, r.feature) for r in scaling.minmax_scale(cells, coef).collect()}


def test_strong_columns_stretch_absent_cells_too(spark):
    cells = spark.createDataFrame([("T", "a", "f", -5.0), ("T", "b", "f", 10.0), ("T", "b", "g", 95.0)], CELL)
    rows = spark.createDataFrame([("T", x) for x in "abc"], "segment string, gigya_id string")
    coef = coefficients(spark, [stats_row("f", -5.0, 10.0, strong=True), stats_row("g", 0.0, 95.0)])
    got = {(r.gigya_id, r.feature): r.value for r in scaling.scale_strong(cells, coef, rows).collect()}
    assert got[("c", "f")] == pytest.approx(5 / 15 * 100 - 5)  # (0 - min) / range, onto -5..95


def test_a_playlist_weight_without_signal_is_removed(spark):
    coef = coefficients(spark, [stats_row("News_Group", 0.0, 4.0, True), stats_row("Quiet_playlist", 0.0, 0.0, True), stats_row("Loud_playlist", -2.0, 0.0, True)])
    cells = spark.createDataFrame([("T", "a", "News_Group", 4.0), ("T", "b", "Loud_playlist", -2.0)], CELL)
    rows = spark.createDataFrame([("T", x) for x in "abc"], "segment string, gigya_id string")
    weights = spark.createDataFrame([("T", "News_Group", 1.0, 0), ("T", "Quiet_playlist", 1.0, 1), ("T", "Loud_playlist", 1.0, 2)],
                                    "segment string, feature string, weight double, weight_pos int")
    gate = scaling.signal_gate(coef, scaling.minmax_scale(cells, coef, rows), weights)
    assert {r.feature: (r.action, round(r.total, 6)) for r in gate.collect()} == {
        "News_Group": ("keep", 100.0), "Quiet_playlist": ("remove_weight", 0.0), "Loud_playlist": ("keep", 200.0)}


@pytest.fixture(scope="module")
def weak(spark):
    """Two segments of different width as numpy matrices and as sparse rows; listener 0 has no cell at all."""
    rng = np.random.default_rng(5)
    out, cells, columns = {}, [], []
    for seg, d in (("P", 12), ("Q", 4)):
        zero = np.where(np.arange(d) % 3 == 0, 25.0, 0.0)
        x = np.where(rng.random((60, d)) < 0.4, rng.random((60, d)) * 100, zero)
        x[0] = zero
        out[seg] = x, zero
        names = [f"c{j:02d}" for j in range(d)]
        columns += [(seg, names[j], j, d, float(zero[j])) for j in range(d)]
        cells += [(seg, f"g{i}", names[j], float(x[i, j])) for i in range(1, 60) for j in range(d) if x[i, j] != 0]
    cols = spark.createDataFrame(columns, "segment string, feature string, idx int, d int, zero double").cache()
    rows = spark.createDataFrame([(s, f"g{i}") for s in out for i in range(60)], "segment string, gigya_id string")
    sparse = reduce.sparse_rows(rows, spark.createDataFrame(cells, CELL).repartition(7), cols).cache()
    return out, cols, sparse


def test_gram_rows_give_the_moments_of_dense_rows(weak):
    out, _, sparse = weak
    parts = reduce.gram(sparse).toPandas()
    assert len(parts) == 13 + 5  # a row per matrix row and one for the sums
    for seg, (x, zero) in out.items():
        s, g = reduce.moments(parts[parts.segment == seg], zero, len(x))
        np.testing.assert_allclose(s, x.sum(axis=0))
        np.testing.assert_allclose(g, x.T @ x)


def test_components_and_scores_equal_numpy(weak, monkeypatch):
    out, cols, sparse = weak
    monkeypatch.setattr(reduce, "SENT_BYTES", 8)  # a pass per segment
    basis = reduce.fit_bases(sparse, cols, 60, ladder=(3, 11), target=0.9).cache()
    chosen = {r.segment: r.n for r in basis.where("chosen").groupBy("segment").agg(F.count("*").alias("n")).collect()}
    got = {(r.segment, r.gigya_id): np.array(r.scores) for r in reduce.raw_scores(sparse, basis).collect()}
    for seg, (x, _) in out.items():
        _, _, vt = np.linalg.svd(x, full_matrices=False)
        ratio = (x @ vt.T).var(axis=0) / x.var(axis=0).sum()
        want = next((k for k in (3, 11) if k <= x.shape[1] and ratio[:k].sum() >= 0.9), None)
        assert chosen.get(seg) == want
        found = [r.ratio for r in basis.where(F.col("segment") == seg).orderBy("component").collect()]
        np.testing.assert_allclose(found, ratio, atol=1e-9)
        if want:
            v = vt[:want] * np.sign(vt[np.arange(want), np.abs(vt[:want]).argmax(axis=1)])[:, None]
            np.testing.assert_allclose(np.stack([got[seg, f"g{i}"] for i in range(60)]), x @ v.T, atol=1e-6)
    assert chosen  # at least one segment is reduced
    scaled = reduce.project(sparse, basis).groupBy("segment", "component").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    assert all(r.lo == pytest.approx(0, abs=1e-9) and r.hi == pytest.approx(100) for r in scaled)


@pytest.mark.parametrize("buckets", [64, 1])
def test_gram_of_many_columns_holds_few_products(weak, monkeypatch, buckets):
    out, cols, sparse = weak
    monkeypatch.setattr(reduce, "PAIRS", 13)  # no dense triangle, many slices
    monkeypatch.setattr(reduce, "BUCKETS", buckets)
    parts = reduce.gram(sparse).toPandas()
    for seg, (x, zero) in out.items():
        np.testing.assert_allclose(reduce.moments(parts[parts.segment == seg], zero, len(x))[1], x.T @ x)
    got = {(r.segment, r.feature_a, r.feature_b): r.value for r in reduce.mean_products(sparse, cols, 60).collect()}
    assert len(got) == 12 * 13 // 2 + 4 * 5 // 2
    for seg, (x, _) in out.items():
        for i in range(x.shape[1]):
            for j in range(i, x.shape[1]):
                assert got[seg, f"c{i:02d}", f"c{j:02d}"] == pytest.approx(x[:, i] @ x[:, j] / 60)


def test_no_task_holds_a_matrix_as_wide_as_its_columns():
    """Rows of two million columns: a dense block of ten rows has 160 MB, a dense triangle 32 TB."""
    import tracemalloc

    import pyarrow as pa
    d = 2_000_000
    cells = [[{"idx": k * 1000 + j * 7, "dev": 1.0 + j} for j in range(20)] for k in range(10)]
    batch = pa.RecordBatch.from_pydict({"segment": pa.array(["W"] * 10), "gigya_id": pa.array([f"g{k}" for k in range(10)]), "d": pa.array([d] * 10, pa.int32()),
                                        "s": pa.array(cells, pa.list_(pa.struct([("idx", pa.int32()), ("dev", pa.float64())])))})
    vectors = {"W": (np.ones((1, d)), np.zeros(1))}
    tracemalloc.start()
    scores = list(reduce._score_task(vectors)([batch]))
    entries = sum(len(b.column("j").values) for b in reduce._gram_task([batch]) if b.column("i")[0].as_py() >= 0)
    assert tracemalloc.get_traced_memory()[1] < 120 << 20
    tracemalloc.stop()
    assert scores[0].column("scores").to_pylist() == [[float(sum(range(1, 21)))]] * 10
    assert entries == 10 * 20 * 21 // 2


def test_wide_segments_get_the_components_of_the_dense_way(weak):
    _, cols, sparse = weak
    dense = reduce.fit_bases(sparse, cols, 60, ladder=(2, 4, 11), target=0.9).where("chosen").orderBy("segment", "component").collect()
    wide = reduce.choose_bases(sparse, cols, 60, ladder=(2, 4, 11), target=0.9, dense=1).orderBy("segment", "component").collect()
    assert [(r.segment, r.component, r.chosen) for r in wide] == [(r.segment, r.component, r.chosen) for r in dense] and dense
    for a, b in zip(wide, dense):
        np.testing.assert_allclose([a.ratio, a.cumulative, a.base, *a.loadings], [b.ratio, b.cumulative, b.base, *b.loadings], atol=1e-6)


def test_the_bound_is_never_below_what_components_explain(spark, weak):
    out, cols, sparse = weak
    bound = reduce.explained_bound(sparse, cols, 60, ladder=(2, 3))
    for seg, (x, _) in out.items():
        eig = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
        assert bound[seg] >= eig[:3].sum() / eig.sum()
    # 400 columns of one listener each: ten components explain a fortieth, which the bound tells without them.
    cols = spark.createDataFrame([("U", f"c{j:03d}", j, 400, 0.0) for j in range(400)], "segment string, feature string, idx int, d int, zero double")
    rows = spark.createDataFrame([("U", f"g{i}") for i in range(400)], "segment string, gigya_id string")
    sparse = reduce.sparse_rows(rows, spark.createDataFrame([("U", f"g{i}", f"c{i:03d}", 100.0) for i in range(400)], CELL), cols)
    assert reduce.explained_bound(sparse, cols, 400)["U"] == pytest.approx(50 / 399, rel=1e-6)
    assert reduce.choose_bases(sparse, cols, 400, dense=10).count() == 0


def test_a_segment_without_any_cell_has_no_variance(spark):
    cols = spark.createDataFrame([("E", "a", 0, 2, 0.0), ("E", "b", 1, 2, 0.0)], "segment string, feature string, idx int, d int, zero double")
    rows = spark.createDataFrame([("E", "g1"), ("E", "g2")], "segment string, gigya_id string")
    sparse = reduce.sparse_rows(rows, spark.createDataFrame([], CELL), cols)
    basis = reduce.fit_bases(sparse, cols, 2)
    assert {(r.ratio, r.chosen) for r in basis.collect()} == {(0.0, False)}
    assert reduce.project(sparse, basis).collect() == []


def test_matrix_rows_hold_every_listener(spark):
    from listenscape.plans.demo import demo_config
    ids = spark.createDataFrame([("g1",), ("g2",)], "gigya_id string")
    rows = matrix.matrix_rows(ids, demo_config().main_segments()).collect()
    assert {tuple(r) for r in rows} == {(s, g) for s in "ABD" for g in ("g1", "g2")}


def test_pivot_columns_add_up_to_the_cells(spark):
    cells = spark.createDataFrame([("A", "g1", "x", 2.0), ("A", "g1", "tail", 3.0), ("A", "g1", None, 4.0), ("B", "g1", "y", 5.0)], CELL)
    got = {r.segment: (r.x, r.y, r.other) for r in matrix.pivot_all(cells, ["x", "y"]).collect()}
    assert got == {"A": (2.0, 0.0, 7.0), "B": (0.0, 5.0, 0.0)}
    with pytest.raises(ValueError):
        matrix.pivot_all(cells, ["x", "other"])


def shuffle_bytes(spark):
    import os
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(os.path.join(d, f)) for root in dirs for d, _, fs in os.walk(root) for f in fs if f.startswith("shuffle_"))


def test_passes_share_the_matrix_rows_and_leave_no_shuffle_behind(spark, weak, monkeypatch):
    import gc
    import os
    out, cols, sparse = weak
    sparse.count()
    monkeypatch.setattr(reduce, "PAIRS", 13)
    gc.collect()
    spark._jvm.System.gc()
    before = shuffle_bytes(spark)
    found = reduce.entries(sparse, cols)
    assert shuffle_bytes(spark) <= before
    folders = {os.path.dirname(f) for f in found.inputFiles()}
    assert len(folders) > 1
    rows = [spark.read.parquet(f).where("i >= 0 and segment = 'P'").select("i").distinct().toPandas()["i"].tolist() for f in folders]
    assert sorted(sum(rows, [])) == list(range(12))  # a matrix row is in one pass
    root = os.path.dirname(next(iter(folders)).split("file:")[-1])
    assert not [f for f in os.listdir(root) if f.startswith("rows-")]
    got = {(r.segment, r.i): (r.j, r.v) for r in found.collect()}
    assert len(got) == 13 + 5
    for seg, (x, zero) in out.items():
        s = x - zero
        np.testing.assert_allclose(got[seg, -1][1], s.sum(axis=0)[got[seg, -1][0]])
        for i in range(x.shape[1]):
            np.testing.assert_allclose(np.bincount(got[seg, i][0], got[seg, i][1], x.shape[1])[i:], (s.T @ s)[i, i:], atol=1e-9)


def test_a_segment_is_decomposed_from_the_entries_that_occur(spark):
    """300 columns of one listener each: 300 entries and 300 sums, not the 45,150 entries of the triangle."""
    cols = spark.createDataFrame([("U", f"c{j:03d}", j, 301, 0.0) for j in range(301)], "segment string, feature string, idx int, d int, zero double")
    rows = spark.createDataFrame([("U", f"g{i}") for i in range(300)], "segment string, gigya_id string")
    sparse = reduce.sparse_rows(rows, spark.createDataFrame([("U", f"g{i}", f"c{i:03d}", 1.0 + i) for i in range(300)], CELL), cols).cache()
    assert reduce.entries(sparse).select(F.sum(F.size("j"))).first()[0] == 600
    assert reduce.entries(sparse, cols).where("size(j) = 0").count() == 1  # the column without a cell
    x = np.diag(np.append(1.0 + np.arange(300), 0.0))[:300]
    _, _, vt = np.linalg.svd(x, full_matrices=True)
    got = [r.ratio for r in reduce.fit_bases(sparse, cols, 300).orderBy("component").collect()]
    np.testing.assert_allclose(got, (x @ vt.T).var(axis=0) / x.var(axis=0).sum(), atol=1e-12)


def test_a_decomposition_makes_no_more_squares_than_its_vectors():
    import tracemalloc
    x = np.random.default_rng(1).random((500, 400))
    s, g = x.sum(axis=0), np.triu(x.T @ x)
    tracemalloc.start()
    b = reduce.choose_basis("T", [""] * 400, 500, s, reduce._complete(g, np.zeros(400), np.zeros(400), 500))
    assert tracemalloc.get_traced_memory()[1] < 2.5 * g.nbytes
    tracemalloc.stop()
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    np.testing.assert_allclose(b.ratios, (x @ vt.T).var(axis=0) / x.var(axis=0).sum(), atol=1e-12)


def test_the_preparation_leaves_few_shuffle_files(spark):
    """Of 312 shuffle files of a run on sf0.01, 25 belong to tables still in use."""
    import gc
    import time

    from listenscape.plans import pipeline
    from listenscape.plans.demo import demo_config
    from listenscape.sources import testdata
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(2)
    before = shuffle_bytes(spark)
    res = pipeline.prepare(spark, testdata.bind(spark, "/root/testdata/sf0.01"), demo_config())
    weak = pipeline.weak_rows(res.split, res.coefficients, matrix.matrix_rows(res.kept, res.assembly.segments), res.norm)
    for _ in range(20):  # the cleaner works beside the driver
        left = shuffle_bytes(spark) - before
        if left < 1_200_000:
            break
        time.sleep(1)
    assert left < 1_200_000, weak  # 600 kB; 2.6 MB with all of them
