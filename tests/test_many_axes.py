"""Density clustering on more than three axes: vectors meet in leaves, against brute force."""

from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tenderlens import session
from tenderlens.operators import balls, dbscan, neighbours
from test_points import brute_labels, distances, frame


def blobs(axes, seed):
    """Blobs, scatter, a crowded ball, and one vector held by many rows."""
    draw = np.random.default_rng(seed)
    parts = [draw.normal(0, 0.3, (150, axes)), draw.normal(1.5, 0.3, (100, axes)), draw.uniform(-2, 3, (120, axes))]
    parts += [draw.normal(3, 0.02, (200, axes)), np.full((90, axes), 2.0)]
    points = np.concatenate(parts)
    return np.round(points, 3)[draw.permutation(len(points))]


def labels(spark, points, eps, min_samples, **more):
    found = dbscan.dbscan(frame(spark, points), "id", eps, min_samples, **more).orderBy("id").toPandas()
    assert found.id.tolist() == list(range(len(points)))
    return found.cluster.to_numpy()


@pytest.mark.parametrize("more", [{}, {"leaf_rows": 6, "tree_leaves": 8}, {"leaf_rows": 24, "direct_pairs": 50}])
def test_labels_by_leaves(spark, more):
    points = blobs(4, 5)
    assert np.array_equal(labels(spark, points, 0.5, 6, **more), brute_labels(points, 0.5, 6))


def test_labels_of_whole_numbers(spark):
    """Distances of exactly eps count, on both sides of a leaf's border."""
    draw = np.random.default_rng(2)
    points = draw.integers(0, 4, (400, 5)).astype(float)
    assert np.array_equal(labels(spark, points, 1.0, 5, leaf_rows=20), brute_labels(points, 1.0, 5))


def test_core_rows_on_five_axes(spark, monkeypatch):
    monkeypatch.setattr(dbscan, "LEAF_VECTORS", 16)
    points = blobs(5, 7)
    found = dbscan.core_rows(frame(spark, points), "id", 0.6, 8).orderBy("id").toPandas()
    assert np.array_equal(found.core, (distances(points) <= 0.6).sum(axis=1) >= 8)


def test_repeated_and_null_keys_keep_all_rows(spark):
    points = blobs(4, 5)[:200]
    rows = [(None if i % 9 == 0 else i % 150, p.tolist()) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id bigint, features array<double>")
    assert dbscan.dbscan(df, "id", 0.5, 6, leaf_rows=24).count() == 200


def test_no_table_grows_with_the_pairs(spark):
    """Cells on six axes have hundreds of others within eps, and balls touch most leaves; neither is written out."""
    points = np.random.default_rng(8).normal(0, 0.25, (1500, 6))
    assert (distances(points) <= 0.6).sum() > 100 * len(points)
    with session.scratch_scope() as folders:
        dbscan.dbscan(frame(spark, points), "id", 0.6, 5).collect()
    sizes = [sum(pq.ParquetFile(f).metadata.num_rows for f in Path(folder.removeprefix("file:")).glob("*/*.parquet")) for folder in folders]
    assert len(sizes) > 5 and max(sizes) <= 4 * len(points)


def test_touched_leaves_come_in_parts(monkeypatch):
    draw = np.random.default_rng(4)
    points = draw.normal(size=(2000, 6))
    tree = neighbours.cut_space(points, 100)
    radii = np.full(len(points), 1.2)
    whole = neighbours.reached(tree, points, radii, gaps=True)
    monkeypatch.setattr(neighbours, "PART_PAIRS", 500)
    parts = list(neighbours.reached_parts(tree, points, radii))
    assert len(whole[0]) > 20 * len(points) and max(len(rows) for rows, *_ in parts) < 500 + len(points)
    assert all(np.array_equal(a, np.concatenate(b)) for a, b in zip(whole, zip(*parts)))


def test_settled_leaves_are_passed_by(spark):
    points = np.random.default_rng(4).uniform(0, 1, (400, 4))
    vectors = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vid bigint, x array<double>")
    for tree_leaves in (None, 6):
        space = neighbours.SpacePartition(vectors, 400, 20, tree_leaves)
        home = space.home(vectors.withColumn("label", F.when(F.col("x")[0] < 0.5, 0).otherwise(F.col("vid") % 2).cast("bigint")))
        home = session.materialise(home.filter("x[1] < 0.7"), "home")
        asking = vectors.withColumns({"label": F.lit(0).cast("bigint"), "radius": F.lit(0.3)})
        every, kept = space.touched(asking, "radius"), space.touched(asking, "radius", ("label", home.select("leaf", "label")))
        needed = home.filter("label <> 0").select("leaf").distinct()
        assert kept.count() < every.count()
        missing = every.join(needed, "leaf").select("vid", "leaf").exceptAll(kept.join(needed, "leaf").select("vid", "leaf"))
        assert missing.isEmpty() and kept.select("vid", "leaf").exceptAll(every.select("vid", "leaf")).isEmpty()


def test_comparisons_within_a_leaf():
    draw = np.random.default_rng(6)
    points, queries = draw.normal(size=(700, 4)), draw.normal(size=(300, 4))
    weights = draw.integers(1, 4, 700)
    near = np.sqrt(sum((queries[:, None, i] - points[None, :, i]) ** 2 for i in range(4))) <= 0.7
    exact = (near * weights).sum(axis=1)
    known = draw.integers(0, 3, 300)
    assert np.array_equal(balls.counts(points, weights, queries, 0.7, 10**6, known), exact + known)
    few = balls.counts(points, weights, queries, 0.7, 8, known)
    assert np.array_equal(np.minimum(few, 8), np.minimum(exact + known, 8))
    values = draw.integers(0, 50, 700)
    none = np.iinfo(np.int64).max
    assert np.array_equal(balls.lowest(points, values, queries, 0.7), np.where(near, values, none).min(axis=1))
    asked = draw.integers(0, 50, 300)
    pairs = {(a, b) for i, j in zip(*np.nonzero(near)) if (a := asked[i]) != (b := values[j])}
    assert set(zip(*balls.linked(points, values, queries, asked, 0.7))) == pairs
    groups = np.where(draw.random(700) < 0.1, draw.integers(0, 9, 700), -1)
    links = (distances(points) <= 0.5) | (groups[:, None] == groups[None, :]) & (groups >= 0)[:, None]
    root = np.arange(700)
    while not np.array_equal(low := np.where(links, root[None, :], 700).min(axis=1), root):
        root = low
    assert np.array_equal(balls.joined(points, groups, 0.5), root)
