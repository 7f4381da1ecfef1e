"""Neighbours, density clustering, KMeans and silhouette against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlens.operators import dbscan, kmeans, neighbours, quality


def frame(spark, points):
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id bigint, features array<double>").repartition(3)


def distances(points):
    return np.sqrt(sum((points[:, None, i] - points[None, :, i]) ** 2 for i in range(points.shape[1])))


def brute_labels(points, eps, min_samples):
    near = distances(points) <= eps
    core = near.sum(axis=1) >= min_samples
    labels, cluster = np.full(len(points), -1), 0
    for start in range(len(points)):
        if not core[start] or labels[start] >= 0:
            continue
        stack, labels[start] = [start], cluster
        while stack:
            for other in np.flatnonzero(near[stack.pop()] & core & (labels < 0)):
                labels[other] = cluster
                stack.append(other)
        cluster += 1
    core_labels = labels.copy()
    for row in np.flatnonzero(~core):
        around = core_labels[near[row] & core]
        if len(around):
            labels[row] = around.min()
    return labels


@pytest.fixture(scope="module")
def cloud():
    """Blobs, scatter, and one vector held by a third of all rows."""
    rng = np.random.default_rng(3)
    points = np.concatenate(
        [
            rng.normal(0, 0.3, (120, 3)),
            rng.normal(2, 0.3, (80, 3)),
            np.tile([[5.0, 5.0, 5.0]], (180, 1)),
            rng.uniform(-3, 6, (100, 3)),
        ]
    )
    return np.round(points, 2)[rng.permutation(480)]


@pytest.mark.parametrize("leaf_rows", [4096, 40])
def test_nearest_distances(spark, cloud, leaf_rows):
    found = neighbours.nearest_distances(frame(spark, cloud), "id", 5, leaf_rows).orderBy("id").toPandas()
    expected = np.sort(distances(cloud), axis=1)[:, :5]
    assert len(found) == len(cloud)
    assert np.array_equal(np.vstack(found.distances), expected)


def test_fewer_rows_than_neighbours(spark):
    found = neighbours.nearest_distances(frame(spark, np.array([[0.0], [3.0]])), "id", 5).orderBy("id").collect()
    assert [r.distances for r in found] == [[0.0, 3.0], [0.0, 3.0]]


@pytest.mark.parametrize("eps, direct", [(0.3, 20_000_000), (0.3, 5), (0.7, 5)])
def test_dbscan(spark, cloud, eps, direct):
    found = dbscan.dbscan(frame(spark, cloud), "id", eps, 5, direct).orderBy("id").toPandas()
    assert np.array_equal(found.cluster, brute_labels(cloud, eps, 5))


def test_dbscan_border_row_and_edges(spark):
    # Two pairs of cores with a border row between them, neighbours exactly eps apart.
    points = np.array([[0.0], [0.0], [0.0], [1.0], [2.0], [2.0], [2.0], [9.0]])
    found = dbscan.dbscan(frame(spark, points), "id", 1.0, 4).orderBy("id").toPandas()
    assert found.cluster.tolist() == brute_labels(points, 1.0, 4).tolist() == [0, 0, 0, 0, 0, 0, 0, -1]
    found = dbscan.dbscan(frame(spark, points), "id", 1.0, 5).orderBy("id").toPandas()
    assert found.cluster.tolist() == brute_labels(points, 1.0, 5).tolist()


def test_no_core_rows(spark):
    found = dbscan.dbscan(frame(spark, np.array([[0.0, 0.0], [5.0, 5.0]])), "id", 0.5, 3).toPandas()
    assert found.cluster.tolist() == [-1, -1]


def test_components_of_a_long_path(spark):
    nodes = spark.range(200).withColumnRenamed("id", "node")
    edges = spark.range(199).filter("id <> 120").select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    roots = dict(dbscan.components(nodes, edges).collect())
    assert {roots[i] for i in range(121)} == {0} and {roots[i] for i in range(121, 200)} == {121}


def test_numbering_over_range_partitions(spark):
    df = spark.createDataFrame([(v,) for v in (30, 10, 20, 10, 50, 40)], "k int").repartition(4)
    for rows in (100, 1):
        assert sorted(dbscan.numbered(df, "k", "n", rows).collect()) == [(10, 0), (20, 1), (30, 2), (40, 3), (50, 4)]


def test_silhouette(spark, cloud):
    labels = np.arange(len(cloud)) % 3
    labels[0] = 9
    df = frame(spark, cloud).withColumn("cluster", F.when(F.col("id") == 0, 9).otherwise(F.col("id") % 3))
    d = distances(cloud)
    scores = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    for block_rows, first in ((4096, 2), (50, 1)):
        assert quality.silhouette(df, block_rows, first).first()[0] == pytest.approx(np.mean(scores), abs=1e-12)
    assert quality.silhouette(df.withColumn("cluster", F.lit(1))).first()[0] == 0.0


def test_silhouette_visits_few_clusters(spark, monkeypatch):
    """Forty clusters far from each other: a row is compared with its own and the next ones only."""
    monkeypatch.setattr(quality, "CENTROID_NUMBERS", 24)
    draw = np.random.default_rng(5)
    centres = draw.uniform(-100, 100, (40, 2))
    labels = draw.integers(0, 40, 800)
    points = centres[labels] + draw.normal(0, 1, (800, 2))
    rows = [(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(points, labels))]
    compared = []
    df = spark.createDataFrame(rows, "id bigint, features array<double>, cluster int")
    found = quality.silhouette(df, 64, compared=compared).first()[0]
    d, scores = distances(points), []
    for i, own in enumerate(labels):
        means = {c: d[i, labels == c].sum() / ((labels == c).sum() - (c == own)) for c in set(labels)}
        a, b = means.pop(own), min(means.values())
        scores.append((b - a) / max(a, b))
    assert found == pytest.approx(np.mean(scores), abs=1e-9)
    assert sum(compared) < 5 * 800


def test_silhouette_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, features array<double>, cluster int")
    assert quality.silhouette(df).first()[0] == 0.0


def test_kmeans(spark, cloud):
    df = frame(spark, cloud)
    state = kmeans.fit(df, "id", 4, n_init=4)
    assert kmeans.fit(df.repartition(1), "id", 4, n_init=4) == kmeans.fit(df.repartition(7), "id", 4, n_init=4) == state
    d = np.sqrt(((cloud[:, None, :] - np.array(state.centroids)[None]) ** 2).sum(-1))
    found = kmeans.detect(df, state).orderBy("id").toPandas()
    assert np.array_equal(found.cluster, d.argmin(axis=1))
    assert np.allclose(found.distance, d.min(axis=1))
    assert (d.min(axis=1) ** 2).sum() == pytest.approx(state.inertia)
    far = d.min(axis=1)
    # Rows of one vector share one distance, which may be the threshold itself.
    assert np.array_equal(found.is_outlier, found.distance > np.quantile(found.distance, 0.95))
    assert np.allclose(found.anomaly_score, far / far.max())
    constant = kmeans.closest_row_distances(df, state).orderBy("id").toPandas()
    assert np.allclose(constant.distance, d.min(axis=0)[d.argmin(axis=1)])


def plain_lloyd(points, centroids):
    while True:
        near = ((points[:, None, :] - centroids[None]) ** 2).sum(-1).argmin(axis=1)
        moved = np.array([points[near == c].mean(axis=0) if (near == c).any() else centroids[c] for c in range(len(centroids))])
        if np.allclose(moved, centroids, atol=1e-13):
            return moved, ((points - moved[near]) ** 2).sum()
        centroids = moved


def test_kmeans_is_the_best_of_its_starts(spark, cloud):
    """Each start moved by plain NumPy to where it no longer moves; one vector holds a third of all rows."""
    state = kmeans.fit(frame(spark, cloud), "id", 5, n_init=6, tol=0.0)
    x, weights = np.unique(cloud, axis=0, return_counts=True)
    found = frame(spark, cloud).groupBy(F.col("features").alias("x")).agg(F.count("*").alias("n")).orderBy(F.xxhash64(F.lit(42), "x")).collect()
    drawn, many = np.array([r.x for r in found]), np.array([float(r.n) for r in found])
    assert len(found) == len(x) and sum(many) == weights.sum()
    ends = [plain_lloyd(cloud, kmeans.seeds(drawn, many, 5, np.random.default_rng([42, n]))) for n in range(6)]
    costs = [cost for _, cost in ends]
    assert state.inertia == pytest.approx(min(costs), rel=1e-9)
    assert np.allclose(state.centroids, ends[int(np.argmin(costs))][0], atol=1e-9)


def test_kmeans_passes(spark, cloud, monkeypatch):
    """All starts share each pass over the rows."""
    passes, plain = [], kmeans._pass
    monkeypatch.setattr(kmeans, "_pass", lambda vectors, starts, *more: passes.append(len(starts)) or plain(vectors, starts, *more))
    kmeans.fit(frame(spark, cloud), "id", 3, n_init=5, max_iter=4)
    assert len(passes) <= 5 and passes[0] == passes[-1] == 5


def test_kmeans_of_few_vectors(spark):
    state = kmeans.fit(frame(spark, np.array([[1.0, 2.0]] * 5 + [[3.0, 2.0]])), "id", 4)
    assert sorted(state.centroids) == [[1.0, 2.0], [3.0, 2.0]] and state.inertia == 0.0
    assert kmeans.fit(frame(spark, np.zeros((3, 2))), "id", 2).centroids == [[0.0, 0.0]]
    with pytest.raises(ValueError):
        kmeans.fit(spark.createDataFrame([], "id bigint, features array<double>"), "id", 2)


def test_elbow(spark, cloud):
    kth = np.sort(np.sort(distances(cloud), axis=1)[:, 4])
    expected = kth[np.argmax(np.diff(kth)) + 1]
    assert neighbours.elbow_eps(frame(spark, cloud), "id", 5).first()["eps"] == pytest.approx(expected)


def test_knn_scores(spark, cloud):
    mean = np.sort(distances(cloud), axis=1)[:, :5].mean(axis=1)
    found = neighbours.knn_scores(frame(spark, cloud), "id", 5).orderBy("id").toPandas()
    assert np.allclose(found.anomaly_score, mean / mean.max())


def test_cells_of_few_valued_axes_meet_few_others(spark):
    """Cells on twelve axes of two values each meet near ones only, not all."""
    draw = np.random.default_rng(3)
    rows = [(i, draw.integers(0, 2, 12).astype(float).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, features array<double>")
    cut = dbscan._Cells(df, "id", 0.5)
    cells = {tuple(x) for _, x in rows}
    assert cut.pairs.count() == len(cells)


def test_neighbours_in_many_dimensions_ask_few_leaves(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(4000, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, features array<double>")
    asked = []
    found = {r.id: r.distances for r in neighbours.nearest_distances(df, "id", 4, leaf_rows=64, asked=asked).collect()}
    for i in range(0, 4000, 37):
        exact = np.sort(np.sqrt(((x - x[i]) ** 2).sum(axis=1)))[:4]
        assert np.allclose(found[i], exact, atol=1e-12)
    # The home leaf alone would send each vector to most of the 62 others.
    assert len(asked) > 1 and sum(asked) < 45 * 4000


def test_two_levels_of_trees(spark, cloud):
    """Tiny trees: leaves of a few rows, a first tree of some leaves and one more below each of them."""
    df = frame(spark, cloud)
    vectors = df.select(F.col("features").alias("x")).distinct()
    count = vectors.count()
    space = neighbours.SpacePartition(vectors, count, 8, tree_leaves=12)
    assert space.below is not None and len(space.top.value[1]) < 12 and space.below.count() > 2
    home = {tuple(r.x): r.leaf for r in space.home(vectors).collect()}
    assert len(home) == count and len(set(home.values())) > 12
    near = space.touched(vectors.withColumn("r", F.lit(0.4)), "r").collect()
    found = {}
    for r in near:
        found.setdefault(tuple(r.x), {})[r.leaf] = r.gap
    points = np.array(list(home))
    for x, leaf in home.items():
        assert found[x][leaf] == 0.0
        far = np.sqrt(((points - np.array(x)) ** 2).sum(axis=1))
        for other in points[far <= 0.4]:
            # No leaf with a row in the ball is left out, and no gap is above a distance there.
            assert found[x][home[tuple(other)]] <= np.sqrt(((other - np.array(x)) ** 2).sum()) * (1 + 1e-9)
    got = neighbours.nearest_distances(df, "id", 5, 8, tree_leaves=12).orderBy("id").toPandas()
    assert np.array_equal(np.vstack(got.distances), np.sort(distances(cloud), axis=1)[:, :5])


def test_dbscan_on_two_levels(spark, cloud, monkeypatch):
    monkeypatch.setattr(neighbours, "TREE_LEAVES", 4)
    monkeypatch.setattr(dbscan, "LEAF_CELLS", 4)
    monkeypatch.setattr(dbscan.near_cells, "__defaults__", (4, None))
    found = dbscan.dbscan(frame(spark, cloud), "id", 0.3, 5).orderBy("id").toPandas()
    assert np.array_equal(found.cluster, brute_labels(cloud, 0.3, 5))


def test_pairs_of_cells_are_not_broadcast(spark):
    """Repeated arrays make the files of pairs small, but not their rows in memory."""
    draw = np.random.default_rng(8)
    cut = dbscan._Cells(frame(spark, draw.normal(0, 1, (300, 6))), "id", 0.6)
    met = cut.rows.join(cut.pairs.select("cell_a", "cell_b"), cut.rows.cell == F.col("cell_a"))
    assert "SortMergeJoin [cell" in met._jdf.queryExecution().executedPlan().toString()
