"""Sums of distances by boxes against all pairs."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenderlens.operators import quality, sums
from tenderlens.operators.neighbours import arrow_matrix, cut_space, flat_tree, homes, reached


def test_nodes_stand_for_far_points():
    draw = np.random.default_rng(2)
    points, weights = draw.uniform(0, 1, (5000, 2)), draw.integers(1, 5, 5000).astype(float)
    nodes, totals = sums.condensed(points, weights, points.min(axis=0), points.max(axis=0))
    assert len(nodes) == sums.NODES**2
    asking = draw.uniform(0, 1, (50, 2)) + [2.5, 0]
    assert sums.weighted_sums(asking, nodes, totals) == pytest.approx(sums.weighted_sums(asking, points, weights), rel=1e-11)


def test_tiles_of_distances_stay_small():
    """3,000 rows meet 2,500 points in tiles of about a megabyte, and the sums are those over all pairs."""
    draw = np.random.default_rng(5)
    asking, points, weights = draw.normal(0, 1, (3000, 2)), draw.normal(0, 1, (2500, 2)), draw.integers(1, 4, 2500).astype(float)
    tracemalloc.start()
    found = sums.weighted_sums(asking, points, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3_000_000
    assert found == pytest.approx(np.sqrt(((asking[:, None] - points[None]) ** 2).sum(axis=2)) @ weights, rel=1e-12)


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_cluster_sums(spark, dims):
    """Two clusters of 4,000 rows, the first with few values on its last axis, one row far away, leaves of 100 rows."""
    draw = np.random.default_rng(dims)
    points = draw.normal(0, 1, (4000, dims))
    points[::2, -1] = np.round(points[::2, -1], 0 if dims > 1 else 3)
    points[7] = 1e6
    label, weight = np.arange(4000) % 2, draw.integers(1, 4, 4000)
    rows = [(i, [float(v) for v in p], int(w), int(c)) for i, (p, w, c) in enumerate(zip(points, weight, label))]
    vectors = spark.createDataFrame(rows, "v bigint, x array<double>, weight bigint, cluster bigint")
    visits = vectors.filter("v % 3 = 0").select("v", "x", (1 - F.col("cluster")).alias("other"))
    found = {r.v: r.total for r in sums.ClusterSums(vectors, 4000, 100).of(visits).collect()}
    assert sorted(found) == list(range(0, 4000, 3))
    for v in range(0, 4000, 30):
        other = label != label[v]
        apart = np.sqrt(((points[other] - points[v]) ** 2).sum(axis=1))
        assert found[v] == pytest.approx(float(apart @ weight[other]), rel=1e-11)


def test_rows_meet_few_others():
    """On a line a leaf takes some boxes and the rows beside it, not all rows."""
    points = np.sort(np.random.default_rng(3).uniform(0, 1, (1 << 16, 1)), axis=0)
    tree = cut_space(points, 128)
    parents, boxes = sums._parents(tree), {}
    order, leaves = reached(tree, points)
    for leaf in np.unique(leaves):
        own, node = points[order[leaves == leaf]], -int(leaf)
        while node is not None:
            low, high = boxes.get(node, (own.min(axis=0), own.max(axis=0)))
            boxes[node] = np.minimum(low, own.min(axis=0)), np.maximum(high, own.max(axis=0))
            node = parents.get(node)
    low, high = boxes[-5]
    met = [(node, far) for at, node, far in sums.boxes_asked(tree, boxes, low[None], high[None]) if len(at)]
    assert sum(not far for _, far in met) <= 6 and len(met) <= 40


@pytest.mark.parametrize("many", [1, 3, 30])
def test_nearest_open_clusters(many):
    """Ties in distance go by name, closed clusters are never visited, and a row may have none left."""
    draw = np.random.default_rng(6)
    far, names = draw.integers(0, 4, (200, 20)).astype(float), draw.permutation(100)[:20]
    open_ = draw.random((200, 20)) < 0.4
    open_[7] = False
    ends, found, clusters = quality._nearest_open(far, names, open_, many)
    for row, (a, b) in enumerate(zip([0, *ends], ends)):
        wanted = sorted((far[row, c], names[c]) for c in range(20) if open_[row, c])[:many]
        assert list(zip(found[a:b], clusters[a:b])) == wanted


def test_rows_pass_without_an_object_each(spark):
    """Placing rows, naming their visits and summing their distances take whole Arrow columns; vectors are not taken apart."""
    draw = np.random.default_rng(8)
    rows = [(i, [float(v) for v in p], 1, i % 3) for i, p in enumerate(draw.normal(0, 1, (300, 2)))]
    vectors = spark.createDataFrame(rows, "v bigint, x array<double>, weight bigint, cluster bigint")
    boxes = sums.ClusterSums(vectors, 300, 50)
    nothing = [F.lit(float("inf")).alias("best"), F.lit(-1.0).alias("after_far"), F.lit(-1).cast("bigint").alias("after_cluster")]
    state = vectors.select("v", "x", "cluster", "weight", *nothing)
    steps = [boxes.space.home(vectors), quality._next_visits(state, quality._centroids(vectors), 2, 2), boxes.of(vectors.select("v", "x", F.lit(1).cast("bigint").alias("other")))]
    for step in steps:
        plan = step._jdf.queryExecution().optimizedPlan().toString()
        assert "InArrow" in plan and "InPandas" not in plan


def test_homes_are_those_reached():
    """Also with rows on a split, missing numbers and a tree of one leaf."""
    draw = np.random.default_rng(9)
    points = np.round(draw.normal(0, 1, (4000, 2)), 2)
    points[5] = np.nan
    for leaves in (1, 2, 500):
        tree = cut_space(points[6:1006], leaves)
        for found, wanted in zip(homes(flat_tree(tree), points), reached(tree, points)):
            assert np.array_equal(found, wanted)


def test_vectors_of_several_lengths_are_refused():
    with pytest.raises(ValueError, match="several lengths"):
        arrow_matrix(pa.array([[1.0, 2.0, 3.0], [4.0]]))


def test_silhouette_by_boxes_and_by_pairs(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [([float(v) for v in p], int(c)) for p, c in zip(draw.normal(0, 1, (3000, 2)), draw.integers(0, 3, 3000))]
    df = spark.createDataFrame(rows, "features array<double>, cluster int")
    boxes = quality.silhouette(df).first()[0]
    monkeypatch.setattr(quality, "MOST_AXES", 0)
    assert boxes == pytest.approx(quality.silhouette(df).first()[0], abs=1e-12)
