"""Operator 10: embedding near-duplicates by dual traversal of cover trees, exact at the threshold.

Vectors are scaled to unit length in double precision, where cosine >= c is distance <= sqrt(2 - 2c).
Equal unit vectors collapse to one point with a weight.

1. The upper levels are a farthest-first net on a bounded sample (``sample_rows``): its first k centres split
   all points into cells, and each cell's covering radius is taken over all its points. Cells larger than
   ``block_rows`` are split by a hash, so a large group of copies is spread over blocks.
2. Every block becomes one cover tree: nested levels with halving radii; a node keeps its centre, its true
   covering radius and a range of points.
3. Pairs of blocks whose cells can hold a link (centre distance <= threshold + both radii) are traversed
   together, level by level; blocks travel in bundles of about ``bundle_rows`` points, and a bundle meets
   another as a whole, so that points are sent once a bundle and not once a block. A node pair is dropped if distance - both radii exceeds the threshold; if
   distance + both radii is within it, all its pairs are links and are counted without being listed.
   What is left at the bottom is compared in double precision.
4. Each task returns link counts per vector and the edges of a spanning forest, never its pairs. Counts
   are summed by Spark and forests joined by components().

Work on m blocks that no bound separates (random directions in many dimensions) is m^2 / 2 block pairs; that
is the nature of an exact search. Driver and broadcast data: the centres (at most ``max_cells``).

Cases: null or zero vectors, and vectors with a null or non-finite component link with nothing; others
link with vectors of their own length only, and each length has its own cells and trees. Equal vectors link. Rows sharing a vec_id keep a row each;
different vectors under one id are one node of the graph where that id is the smallest of their equal vectors, so that
their links are added up and they share a component. Empty tables give empty
results. Extra columns and labels are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, stage, table

SLACK = 1e-9


def _unit_rows(batches):
    """vec_id and the unit vector as little-endian doubles; null where there is no direction."""
    for batch in batches:
        out = []
        for v in batch.column("embedding").to_pylist():
            x = np.array([np.nan if c is None else c for c in v], np.float64) if v else np.zeros(0)
            norm = 0.0
            if len(x) and np.isfinite(x).all():
                top = np.abs(x).max()
                if top > 0:
                    x = x / top
                    norm = np.sqrt((x * x).sum())
            out.append((x / norm).astype("<f8").tobytes() if norm > 0 else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "unit"])


def net(points: np.ndarray, k: int) -> np.ndarray:
    """The first k points of a farthest-first order: each prefix is a level of a cover tree's net."""
    chosen = [0]
    far = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(k, len(points)):
        i = int(far.argmax())
        if far[i] <= 0:
            break
        chosen.append(i)
        far = np.minimum(far, np.linalg.norm(points - points[i], axis=1))
    return points[chosen]


def build_tree(points: np.ndarray, smallest: float = 1 / 64) -> dict:
    """Levels from one root to single points. Points are reordered so that a node is a range of them."""
    order = np.arange(len(points))
    root = np.linalg.norm(points - points[0], axis=1)
    levels = [{"centre": np.array([0]), "radius": np.array([root.max()]), "lo": np.array([0]), "hi": np.array([len(points)]), "parent": np.array([0])}]
    r = 1.0
    while r >= smallest and len(levels[-1]["lo"]) < len(points):
        last, rows = levels[-1], []
        for node, (c, lo, hi, cover) in enumerate(zip(last["centre"], last["lo"], last["hi"], last["radius"])):
            if cover <= r:
                rows.append((c, cover, lo, hi, node))
                continue
            left, at, centre = order[lo:hi].copy(), lo, c
            while len(left):
                d = np.linalg.norm(points[left] - points[centre], axis=1)
                near = d <= r
                own = left[near]
                order[at:at + len(own)] = own
                rows.append((centre, d[near].max(), at, at + len(own), node))
                left, at = left[~near], at + len(own)
                centre = left[0] if len(left) else None
        levels.append(dict(zip(("centre", "radius", "lo", "hi", "parent"), (np.array(x) for x in zip(*rows)))))
        r /= 2
    back = np.empty(len(points), np.int64)
    back[order] = np.arange(len(points))
    for lv in levels:
        lv["centre"] = back[lv["centre"]]
    return {"points": points[order], "order": order, "levels": levels}


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number of each of n nodes under edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]
    return label


def dual(ta: dict, tb: dict, cosine: float, weight_a: np.ndarray, weight_b: np.ndarray):
    """All links between two trees: (links of each point of a, of b, edges of a spanning set)."""
    t = np.sqrt(2 - 2 * cosine)
    la, lb = ta["levels"], tb["levels"]
    pa_, pb = ta["points"], tb["points"]
    diff_a, diff_b = np.zeros(len(pa_) + 1), np.zeros(len(pb) + 1)
    sum_a, sum_b = np.concatenate([[0], np.cumsum(weight_a)]), np.concatenate([[0], np.cumsum(weight_b)])
    edges = []

    def take(a_lo, a_hi, b_lo, b_hi, ca, cb):
        """Every point of each range of a links with every point of the range of b."""
        np.add.at(diff_a, a_lo, sum_b[b_hi] - sum_b[b_lo])
        np.add.at(diff_a, a_hi, -(sum_b[b_hi] - sum_b[b_lo]))
        np.add.at(diff_b, b_lo, sum_a[a_hi] - sum_a[a_lo])
        np.add.at(diff_b, b_hi, -(sum_a[a_hi] - sum_a[a_lo]))
        na, nb = a_hi - a_lo, b_hi - b_lo
        at = np.repeat(a_lo - np.cumsum(na) + na, na) + np.arange(na.sum())
        bt = np.repeat(b_lo - np.cumsum(nb) + nb, nb) + np.arange(nb.sum())
        pairs = np.concatenate([np.column_stack([at, np.repeat(cb, na)]), np.column_stack([np.repeat(ca, nb), bt])])
        edges.append(np.unique(pairs, axis=0))

    depth = max(len(la), len(lb)) + 1
    bottom = lambda p: {"centre": np.arange(len(p)), "radius": np.zeros(len(p)), "lo": np.arange(len(p)), "hi": np.arange(len(p)) + 1}

    def level(levels, points, i):
        """Level i of a tree and, for each node, its node one level up; the last level holds the points."""
        if i < len(levels):
            return levels[i], levels[i]["parent"]
        if i == depth - 1:
            top = levels[-1]
            return bottom(points), np.repeat(np.arange(len(top["lo"])), top["hi"] - top["lo"])
        return levels[-1], np.arange(len(levels[-1]["lo"]))

    ia, ib = np.array([0]), np.array([0])
    for i in range(depth):
        (xa, up_a), (xb, up_b) = level(la, pa_, i), level(lb, pb, i)
        n_a, n_b = len(xa["lo"]), len(xb["lo"])
        if i:
            kids_a, kids_b = np.bincount(up_a, minlength=prev[0]), np.bincount(up_b, minlength=prev[1])
            first_a, first_b = np.cumsum(kids_a) - kids_a, np.cumsum(kids_b) - kids_b
            many = kids_a[ia] * kids_b[ib]
        # Dense where much is left to compare, else a list of pairs in pieces.
        if not i or many.sum() > 0.05 * n_a * n_b:
            if i:
                open_ = np.zeros(prev, bool)
                open_[ia, ib] = True
            keep = []
            for s in range(0, n_a, 1024):
                cos = pa_[xa["centre"][s:s + 1024]] @ pb[xb["centre"]].T
                far = t + SLACK + xa["radius"][s:s + 1024, None] + xb["radius"][None]
                ok = 2 - 2 * cos <= far * far
                if i:
                    ok &= open_[up_a[s:s + 1024]][:, up_b]
                r, c = np.nonzero(ok)
                keep.append((r + s, c, cos[r, c]))
            ja, jb, cos = (np.concatenate(x) for x in zip(*keep))
        else:
            keep = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            for s in range(0, len(ia), 4096):
                m = many[s:s + 4096]
                of = np.repeat(np.arange(s, s + len(m)), m)
                k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                ja, jb = first_a[ia[of]] + k // kids_b[ib[of]], first_b[ib[of]] + k % kids_b[ib[of]]
                for u in range(0, len(ja), 1 << 16):
                    a, b = ja[u:u + (1 << 16)], jb[u:u + (1 << 16)]
                    cos = np.einsum("ij,ij->i", pa_[xa["centre"][a]], pb[xb["centre"][b]])
                    ok = 2 - 2 * cos <= (t + SLACK + xa["radius"][a] + xb["radius"][b]) ** 2
                    keep.append((a[ok], b[ok], cos[ok]))
            ja, jb, cos = (np.concatenate(x) for x in zip(*keep))
        if i == depth - 1:
            ok = cos >= cosine
            ja, jb = ja[ok], jb[ok]
            diff = np.bincount(ja, weights=weight_b[jb], minlength=len(pa_)), np.bincount(jb, weights=weight_a[ja], minlength=len(pb))
            edges.append(np.column_stack([ja, jb]))
            break
        room = t - SLACK - xa["radius"][ja] - xb["radius"][jb]
        whole = (room > 0) & (2 - 2 * cos <= room * room - SLACK)
        if whole.any():
            a, b = ja[whole], jb[whole]
            take(xa["lo"][a], xa["hi"][a], xb["lo"][b], xb["hi"][b], xa["centre"][a], xb["centre"][b])
        ia, ib, prev = ja[~whole], jb[~whole], (n_a, n_b)
    count_a = diff[0] + np.cumsum(diff_a[:-1])
    count_b = diff[1] + np.cumsum(diff_b[:-1])
    return np.rint(count_a).astype(np.int64), np.rint(count_b).astype(np.int64), np.concatenate(edges)


def _trees(batches):
    """One packed tree for each block; a block's rows arrive as one group."""
    for batch in batches:
        out = []
        for ids, units, weights in zip(*(batch.column(c).to_pylist() for c in ("ids", "units", "weights"))):
            points = np.frombuffer(b"".join(units), "<f8").reshape(len(units), -1)
            tree = build_tree(points)
            tree["ids"], tree["weights"] = np.array(ids)[tree.pop("order")], None
            rank = {v: w for v, w in zip(ids, weights)}
            tree["weights"] = np.array([rank[v] for v in tree["ids"].tolist()], np.float64)
            out.append(pickle.dumps(tree, protocol=5))
        yield pa.RecordBatch.from_arrays([batch.column("cell"), batch.column("part"), pa.array(out, pa.binary())], ["cell", "part", "tree"])


def _traverse(cosine: float):
    def run(batches):
        for batch in batches:
            for same, a, b in zip(batch.column("same").to_pylist(), batch.column("trees_a").to_pylist(), batch.column("trees_b").to_pylist()):
                trees = [pickle.loads(x) for x in a]
                others = trees if same else [pickle.loads(x) for x in b]
                for i, ta in enumerate(trees):
                    for tb in others[i if same else 0:]:
                        yield links(ta, tb)

    def links(ta: dict, tb: dict) -> pa.RecordBatch:
        same = ta is tb
        na, nb, edges = dual(ta, tb, cosine, ta["weights"], tb["weights"])
        n = len(na)
        if same:
            ids, count = ta["ids"], na - 1  # a point's link with itself
            label = _forest(n, edges[:, 0], edges[:, 1])
        else:
            ids, count = np.concatenate([ta["ids"], tb["ids"]]), np.concatenate([na, nb])
            label = _forest(n + len(nb), edges[:, 0], edges[:, 1] + n)
        some = np.flatnonzero((count > 0) | (label != np.arange(len(label))))
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(count[some]), pa.array(ids[label[some]])], ["rep", "n", "root"])

    return run


def link_groups(vectors: DataFrame, cosine: float = 0.9, block_rows: int = 2048, bundle_rows: int = 8192, sample_rows: int = 4096, max_cells: int = 512) -> DataFrame:
    """vec_id, n_links, component_id for every row of ``vectors`` (vec_id, embedding)."""
    rows = stage(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_unit_rows, "vec_id long, unit binary"), "units")
    # A vector alone in its length links with nothing.
    sizes = [r.n for r in rows.where("unit IS NOT NULL").groupBy(F.length("unit").alias("n")).count().where("count > 1").orderBy("n").collect()]
    if not sizes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    points = stage(rows.where("unit IS NOT NULL").groupBy("unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "points")
    found = None
    for n in sizes:  # vectors of different lengths cannot link
        own = _links_among(points.where(F.length("unit") == n), cosine, block_rows, bundle_rows, sample_rows, max_cells)
        found = own if found is None else found.unionAll(own)
    counts = found.groupBy("rep").agg(F.sum("n").alias("n_links"))
    groups = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (points.select("unit", "rep").join(counts, "rep", "left")
             .join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
             .select("unit", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    return (rows.join(named, "unit", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")))


def _links_among(points: DataFrame, cosine: float, block_rows: int, bundle_rows: int, sample_rows: int, max_cells: int) -> DataFrame:
    """rep, n, root: link counts and forest edges of ``points`` (unit, rep, weight), all of one length."""
    spark = points.sparkSession
    total = points.count()
    k = int(np.clip(total // (block_rows // 2), 1, max_cells))
    sample = points.select("unit").orderBy(F.xxhash64("unit")).limit(sample_rows).collect()  # at most sample_rows vectors
    centres = net(np.frombuffer(b"".join(bytes(r.unit) for r in sample), "<f8").reshape(len(sample), -1), k)

    def assign(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("unit").to_pylist()), "<f8").reshape(batch.num_rows, -1)
            cell = (x @ centres.T).argmax(axis=1) if len(x) else np.zeros(0, np.int64)
            d = np.linalg.norm(x - centres[cell], axis=1)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("rep", "unit", "weight")], pa.array(cell, pa.int64()), pa.array(d)],
                                             ["rep", "unit", "weight", "cell", "d"])

    celled = stage(points.mapInArrow(assign, "rep long, unit binary, weight long, cell long, d double"), "cells")
    cells = {r.cell: r for r in celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("r")).collect()}  # at most max_cells rows
    parts = F.create_map(*[F.lit(x) for c, r in cells.items() for x in (c, -(-r.n // block_rows))])
    blocks = (celled.withColumn("part", F.pmod(F.xxhash64("rep"), parts[F.col("cell")].cast("long")))
              .groupBy("cell", "part").agg(F.collect_list("rep").alias("ids"), F.collect_list("unit").alias("units"), F.collect_list("weight").alias("weights")))
    t = float(np.sqrt(2 - 2 * cosine)) + SLACK
    near = [(a, b) for a in sorted(cells) for b in sorted(cells)
            if a <= b and np.linalg.norm(centres[a] - centres[b]) <= t + cells[a].r + cells[b].r + SLACK]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # a row holds a block
        trees = stage(blocks.mapInArrow(_trees, "cell long, part long, tree binary"), "trees")
        # Cells in order fill bundles of about bundle_rows points, the parts of a large cell several of them.
        heap, filled = {}, 0
        for c in sorted(cells):
            heap[c], filled = filled, filled + cells[c].n
        first = F.create_map(*[F.lit(x) for c, r in cells.items() for x in (c, heap[c])])
        share = F.create_map(*[F.lit(x) for c, r in cells.items() for x in (c, r.n // -(-r.n // block_rows))])
        bundle = F.floor((first[F.col("cell")] + F.col("part") * share[F.col("cell")]) / bundle_rows)
        bundles = stage(trees.withColumn("bundle", bundle).groupBy("bundle").agg(F.collect_list("tree").alias("trees"), F.collect_set("cell").alias("cells")), "bundles")
        inside = bundles.select("bundle", F.explode("cells").alias("cell"))
        pairs = (spark.createDataFrame(near + [(b, a) for a, b in near if a < b], "cell_a long, cell_b long")
                 .join(inside.toDF("a", "cell_a"), "cell_a").join(inside.toDF("b", "cell_b"), "cell_b")
                 .where("a <= b").select("a", "b").distinct())
        both = (pairs.join(bundles.select("bundle", "trees").toDF("a", "trees_a"), "a")
                .join(bundles.select("bundle", "trees").toDF("b", "trees_b"), "b")
                .repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(near) // 8), "a", "b")
                .select(F.expr("a = b").alias("same"), "trees_a", "trees_b"))
        found = stage(both.mapInArrow(_traverse(cosine), "rep long, n long, root long"), "vector-links")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    return found


def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = link_groups(table(spark, sf_dir, "embeddings"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
