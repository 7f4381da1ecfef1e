import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenderlens.operators import features, forest
from tenderlens.sources import models

ROWS = [
    (1000, 3, 1, "award"),
    (2000, 2, 2, "notice"),
    (1500, 4, 3, "award"),
    (50000, 1, 4, "award"),
    (1200, 3, 2, "notice"),
]


@pytest.fixture
def table(spark):
    df = spark.createDataFrame(ROWS, "value_eur bigint, bidder_count bigint, organization_size bigint, notice_type string")
    return df.withColumn("row", F.monotonically_increasing_id().cast("string"))


def test_names_with_an_id_inside_are_left_out(table):
    assert features.model_features(table) == (["value_eur", "organization_size"], ["notice_type", "row"])
    assert features.model_features(table, whole_word=True)[0] == ["value_eur", "bidder_count", "organization_size"]
    assert features.cluster_features(table) == ["value_eur", "organization_size"]


def test_scoring_outputs_are_not_features(spark):
    df = spark.createDataFrame([(1.0, True, "NORMAL", 0.5, 1)], "v double, is_outlier boolean, outlier_status string, anomaly_score double, cluster int")
    assert features.model_features(df) == (["v"], [])


def test_matrix(spark):
    df = spark.createDataFrame(
        [(1.0, None, "b", 7.0), (2.0, None, None, 7.0), (4.0, None, "a", 7.0), (None, None, "b", 7.0), (3.0, None, "a", 7.0)],
        "x double, empty double, kind string, constant double",
    )
    state = features.fit(df, ["x", "empty", "constant"], ["kind"])
    assert state.numeric["x"][0] == 2.5 and "empty" not in state.numeric
    assert state.categorical == {"kind": ("a", 2)}
    assert sorted((r.value, r.code) for r in spark.read.parquet(state.categories).collect()) == [("a", 0), ("b", 1)]
    filled = np.array([1, 2, 4, 2.5, 3])
    z = (filled - filled.mean()) / filled.std()
    got = [r.features for r in features.with_features(df, state).collect()]
    expected = [[z[0], 0, 0, 1], [z[1], 0, 1, 0], [z[2], 0, 1, 0], [z[3], 0, 0, 1], [z[4], 0, 1, 0]]
    assert np.allclose(got, expected)
    assert np.allclose([r.features.toArray() for r in features.with_vectors(df, state).collect()], expected)
    coded = [r.features for r in features.with_codes(df, state).collect()]
    assert np.allclose(coded, [[*row[:2], row[3]] for row in expected])
    unseen = spark.createDataFrame([("c",)], "kind string")
    assert np.allclose(features.with_features(unseen, state).first().features, [(0 - filled.mean()) / filled.std(), 0, 0, 0])
    absent = spark.createDataFrame([(1.0,)], "x double")
    assert np.allclose(features.with_features(absent, state).first().features[2:], [0, 0])
    assert features.FeatureState.from_dict(state.to_dict()) == state


def test_many_categories(spark, monkeypatch):
    """A value per row: numbered in order over several ranges, joined by a shuffle, rows as wide as before."""
    monkeypatch.setattr(features, "MOST_BROADCAST", 100)
    df = spark.range(1500).select("id", F.concat(F.lit("c"), F.col("id")).alias("kind"), (F.col("id") % 3).cast("string").alias("few"))
    state = features.fit(df, [], ["kind", "few"])
    assert state.categorical == {"kind": ("c0", 1500), "few": ("0", 3)} and state.width == 1503
    order = {value: code for code, value in enumerate(sorted(f"c{i}" for i in range(1500)))}
    assert {r.id: r.features for r in features.with_codes(df, state).collect()} == {i: [order[f"c{i}"], i % 3] for i in range(1500)}
    rows = features.with_vectors(df, state).collect()
    assert all(r.features.size == 1503 and r.features.indices.tolist() == [order[r.kind], 1500 + r.id % 3] for r in rows)
    coded = features.encode_many(df, "kind", "hot")
    assert coded.first().hot.size == 1500


def test_categories_are_numbered_by_ranges(spark):
    rows = [(f, f"v{i}") for f in ("a", "b c", "d") for i in range(700)]
    counts = spark.createDataFrame(rows, "feature string, value string").repartition(7)
    found = features.numbered_categories(counts).collect()
    order = {f"v{i}": code for code, i in enumerate(sorted(range(700), key=lambda i: f"v{i}"))}
    assert sorted((r.feature, r.value, r.code) for r in found) == sorted((f, v, order[v]) for f, v in rows)


def test_a_million_categories(spark):
    """A forest learns from a text column with a million values; the model and its rows stay small."""
    df = spark.range(1_000_000).select(F.col("id").alias("row"), (F.col("id") % 1000).cast("double").alias("v"), F.concat(F.lit("buyer "), F.col("id")).alias("buyer"))
    state = features.fit(df, ["v"], ["buyer"])
    assert state.categorical == {"buyer": ("buyer 0", 1_000_000)}
    assert len(json.dumps(state.to_dict())) < 2000
    assert {r.n for r in features.with_codes(df, state).select(F.size("features").alias("n")).distinct().collect()} == {2}
    trained = forest.train(df, "row", state, trees=10)
    assert trained.first_code == 1 and len(trained.nodes) <= 10 * 511
    coded = trained.nodes[trained.nodes.feature == 1]
    assert len(coded) and coded.split.between(0, 999_999).all()
    scored = forest.predict(df.limit(100), state, trained)
    assert scored.count() == 100


def test_code_splits_are_splits_on_one_hot_columns():
    """The same draws on codes and on 0/1 columns give trees that part rows alike."""
    rng = np.random.default_rng(3)
    points = np.column_stack([rng.normal(size=200), rng.integers(0, 4, 200), rng.integers(0, 2, 200)])
    nodes = {n: (f, s, z) for n, f, s, z in forest.grow(points, np.random.default_rng(1), 8, 1)}
    assert {f for f, _, _ in nodes.values()} >= {0, 1, 2}
    sizes = {0: np.arange(200)}
    for node in sorted(nodes):
        feature, split, size = nodes[node]
        at = sizes[node]
        assert len(at) == size
        if feature >= 0:
            right = points[at, feature] > split if feature == 0 else points[at, feature] == split
            assert 0 < right.sum() < len(at)
            sizes[2 * node + 1], sizes[2 * node + 2] = at[~right], at[right]
    table = pd.DataFrame([(0, n, f, s, z) for n, (f, s, z) in nodes.items()], columns=["tree", "node", "feature", "split", "size"])
    depths = forest.mean_path(points, forest._tables(table, 8), 1)
    for node, at in sizes.items():
        if nodes[node][0] < 0:
            level = int(np.log2(node + 1))
            assert np.allclose(depths[at], level + forest.average_path(len(at)))


def slow_path(point, nodes):
    at, depth = 0, 0
    while nodes[at][0] >= 0:
        feature, split, _ = nodes[at]
        at, depth = 2 * at + 1 + (point[feature] > split), depth + 1
    size = nodes[at][2]
    rest = 0.0 if size <= 1 else 1.0 if size == 2 else 2 * (np.log(size - 1) + np.euler_gamma) - 2 * (size - 1) / size
    return depth + rest


def test_forest_scores(spark):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=(600, 3)), [[9.0, 9.0, 9.0]]])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "id bigint, features array<double>")
    state = forest.set_offset(df, forest.fit_trees(df, "id", trees=20))
    again = forest.fit_trees(df.repartition(5), "id", trees=20)
    assert state.nodes.equals(again.nodes)
    leaves = state.nodes[state.nodes.feature < 0].groupby("tree")["size"].sum()
    assert len(leaves) == 20 and (leaves == 256).all()
    trees = [
        {int(n): (int(f), s, int(z)) for n, f, s, z in zip(t["node"], t["feature"], t["split"], t["size"])}
        for _, t in state.nodes.groupby("tree")
    ]
    expected = [-(2 ** (-np.mean([slow_path(p, t) for t in trees]) / forest.average_path(256))) for p in points]
    scores = df.select("id", forest.score_column(df, state).alias("s")).orderBy("id").toPandas()
    assert np.allclose(scores.s, expected)
    assert scores.s.idxmin() == 600
    assert state.offset == pytest.approx(np.quantile(expected, 0.05))


def test_large_tables_draw_distinct_rows_per_tree(spark):
    df = spark.range(40_000).select("id", F.array(F.rand(1), F.rand(2)).alias("features"))
    drawn = forest.tree_samples(df, "id", 10, 256, 40_000, 42).groupBy("tree").count().collect()
    assert len(drawn) == 10 and all(r["count"] == 256 for r in drawn)


def test_forest_run_and_reload(spark, table, tmp_path):
    state = features.fit(table, *[[c for c in names if c != "row"] for names in features.model_features(table)])
    trained = forest.train(table, "row", state, contamination=0.1)
    scored = forest.predict(table, state, trained, "2024-01-01 00:00:00")
    rows = scored.collect()
    assert len(rows) == 5 and sum(r.is_outlier for r in rows) >= 1
    assert {r.outlier_status for r in rows if r.is_outlier} == {"OUTLIER"}
    path = models.save_forest(spark, str(tmp_path / "model"), state, trained, "2024-01-01 00:00:00")
    loaded = models.load_forest(spark, path)
    assert loaded[1].contamination == 0.1
    again = forest.predict(table, *loaded, "2024-01-01 00:00:00")
    assert sorted(again.collect()) == sorted(rows)


def test_drawing_leaves_rows_where_they_are(spark):
    from tenderlens.session import materialise

    df = materialise(spark.range(5000).select("id", F.array(F.rand(1)).alias("features")), "rows")
    plan = forest.tree_samples(df, "id", 10, 256, 5000, 42)._jdf.queryExecution().executedPlan().toString()
    before_draw = plan[plan.index("Generate") :]
    assert "BroadcastExchange" in before_draw and "hashpartitioning" not in before_draw


def test_drawing_is_compiled(spark):
    """A row meets the trees in a compiled loop, not in an interpreted function over an array; the draw is the hashes' own."""
    from tenderlens.session import materialise

    df = materialise(spark.range(3000).select("id", F.array(F.col("id") * 0.5).alias("features")), "rows")
    drawn = forest.tree_samples(df, "id", 7, 64, 3000, 42)
    assert "lambda" not in drawn._jdf.queryExecution().executedPlan().toString()
    place = "shiftrightunsigned(xxhash64(xxhash64(id, features), 0L, 42, {}), 11)"
    for tree in range(7):
        lowest = df.orderBy(F.expr(place.format(tree))).limit(64).select("features")
        assert sorted(r.features for r in drawn.filter(F.col("tree") == tree).collect()) == sorted(r.features for r in lowest.collect())


def test_samples_of_null_and_repeated_keys(spark):
    from tenderlens.session import materialise

    for key in ("cast(null as bigint)", "id % 3", "if(id % 3 = 0, null, id)"):
        for features in ("array(cast(id as double))", "array(1.0D)"):
            df = materialise(spark.range(20_000).selectExpr(f"{key} as row", f"{features} as features"), "rows")
            drawn = forest.tree_samples(df, "row", 100, 256, 20_000, 41).groupBy("tree").count().collect()
            assert len(drawn) == 100 and {r["count"] for r in drawn} == {256}
