"""Queries over feature rows and points: features, forest, KMeans, density clustering."""

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tenderlens.functions import scalars as S
from tenderlens.functions.quantiles import exact_quantile, sample_rows
from tenderlens.operators import dbscan, features, forest, kmeans, neighbours, quality
from tenderlens.operators.kmeans import KMeansState
from tenderlens.plans import flows, oracle
from tenderlens.plans.catalog_notices import column_fill, notice_id
from tenderlens.plans.oracle import CENTROIDS, FEATURES, FLAGGED, NOTICES, POINTS, select
from tenderlens.plans.register import query
from tenderlens.session import materialise, scratch_path, spread
from tenderlens.sources import models, tables

KEY = "notice-identifier"
EPS, MIN_SAMPLES = 0.05, 5


def feature_table(spark, folder):
    """Feature rows, written once: fitting reads them several times."""
    return materialise(tables.feature_rows(spark, folder), "features")


def points(spark, folder):
    """Customers with standardised balance and nation as features."""
    table = tables.customer_features(spark, folder)
    return features.with_features(table, features.fit_zero_filled(table, ["balance", "nation"]))


def region_centroids(spark, folder, df) -> KMeansState:
    """The mean point of each region, at most one per region row."""
    nation = tables.table(spark, folder, "nation")
    placed = df.join(nation, df.nation == nation.n_nationkey)
    means = placed.groupBy("n_regionkey").agg(F.avg(F.col("features")[0]).alias("x"), F.avg(F.col("features")[1]).alias("y"))
    return KMeansState([[row.x, row.y] for row in means.orderBy("n_regionkey").collect()])


def assigned(spark, folder):
    df = points(spark, folder)
    return df, region_centroids(spark, folder, df)


@query(
    "f1_feature_choice",
    select(
        FEATURES,
        "select 0 as position, 'total-value-eur' as column_name, count(eur) non_null from f union all "
        "select 1, 'total-value-eur-log', count(log_eur) from f union all select 2, 'quantity', count(quantity) from f union all "
        "select 3, 'discount', count(discount) from f union all select 4, 'notice-type', count(notice_type) from f",
    ),
)
def f1(spark, folder):
    rows = tables.feature_rows(spark, folder)
    numeric, categorical = features.model_features(rows)
    return column_fill(rows.select(*[S.col(c) for c in numeric + categorical]))


@query(
    "f2_feature_choice_numeric",
    select(
        FEATURES,
        "select 0 as position, 'total-value-eur' as column_name, count(eur) non_null from f union all "
        "select 1, 'total-value-eur-log', count(log_eur) from f union all select 2, 'quantity', count(quantity) from f union all "
        "select 3, 'discount', count(discount) from f",
    ),
)
def f2(spark, folder):
    rows = tables.feature_rows(spark, folder)
    return column_fill(rows.select(*[S.col(c) for c in features.cluster_features(rows)]))


@query(
    "f3_median_impute",
    select(
        FEATURES,
        "select notice_id, round(coalesce(eur, (select quantile_cont(eur, 0.5) from f)), 6) value_eur, "
        "round(coalesce(quantity, (select quantile_cont(quantity, 0.5) from f)), 6) quantity from f",
    ),
)
def f3(spark, folder):
    rows = feature_table(spark, folder)
    fills = features.medians(rows, ["total-value-eur", "quantity"])
    filled = {c: F.round(F.coalesce(S.col(c), F.lit(m)), 6) for c, m in fills.items()}
    return rows.withColumns(filled).select(notice_id(), S.col("total-value-eur").alias("value_eur"), "quantity")


@query(
    "f4_mode_impute",
    select(
        FEATURES,
        "select notice_id, coalesce(bidder_size, (select bidder_size from f where bidder_size is not null "
        "group by bidder_size order by count(*) desc, bidder_size limit 1)) bidder_size from f",
    ),
)
def f4(spark, folder):
    rows = feature_table(spark, folder)
    mode = F.broadcast(features.modes(rows, ["primary-bidder-size"]).select(F.col("value").alias("mode")))
    return rows.crossJoin(mode).select(notice_id(), F.coalesce(S.col("primary-bidder-size"), F.col("mode")).alias("bidder_size"))


_FILLED = (
    "fe as (select f.*, coalesce(eur, (select quantile_cont(eur, 0.5) from f)) e2, "
    "coalesce(quantity, (select quantile_cont(quantity, 0.5) from f)) q2, "
    "coalesce(discount, (select quantile_cont(discount, 0.5) from f)) d2 from f)",
    "fs as (select *, (e2 - avg(e2) over ()) / stddev_pop(e2) over () z0, "
    "(log_eur - avg(log_eur) over ()) / stddev_pop(log_eur) over () z1, "
    "(q2 - avg(q2) over ()) / stddev_pop(q2) over () z2, (d2 - avg(d2) over ()) / stddev_pop(d2) over () z3, "
    "avg(d2) over () dm, stddev_pop(d2) over () ds from fe)",
)


@query("f5_standardise", select(FEATURES, "select notice_id, round(z0, 6) z0, round(z2, 6) z2 from fs", *_FILLED))
def f5(spark, folder):
    rows = feature_table(spark, folder)
    state = features.fit(rows, ["total-value-eur", "quantity"], [])
    z = F.col("features")
    return features.with_features(rows, state).select(notice_id(), F.round(z[0], 6).alias("z0"), F.round(z[1], 6).alias("z2"))


_SIZES = ("large", "micro", "small", "sme", "unknown")


@query(
    "f6_one_hot",
    select(
        FEATURES,
        "select notice_id, "
        + ", ".join(f"cast(coalesce(bidder_size, mo) = '{s}' as integer) * 1.0::double as size_{s}" for s in _SIZES)
        + " from f, (select bidder_size mo from f where bidder_size is not null group by bidder_size "
        "order by count(*) desc, bidder_size limit 1)",
    ),
)
def f6(spark, folder):
    rows = feature_table(spark, folder)
    coded = features.with_vectors(rows, features.fit(rows, [], ["primary-bidder-size"]))
    places = vector_to_array("features")
    return coded.select(notice_id(), *[places[i].alias(f"size_{s}") for i, s in enumerate(_SIZES)])


_HOT = (
    "(select count(distinct notice_type) from f t where t.notice_type < fs.notice_type)",
    "ty as (select notice_type, row_number() over (order by notice_type) hot from (select distinct notice_type from f))",
)


@query(
    "f7_matrix",
    select(
        FEATURES,
        "select notice_id, round(z0, 6) z0, round(z1, 6) z1, round(z2, 6) z2, round(z3, 6) z3, cast(hot as bigint) hot, "
        "cast(4 + (select count(*) from ty) as integer) width from fs join ty on fs.notice_type = ty.notice_type",
        *_FILLED,
        _HOT[1],
    ),
)
def f7(spark, folder):
    rows = feature_table(spark, folder)
    z = vector_to_array("features")
    coded = features.with_vectors(rows, features.fit(rows, *features.model_features(rows)))
    hot = F.array_position(F.slice(z, F.lit(5), F.size(z) - 4), 1.0).alias("hot")
    return coded.select(notice_id(), *[F.round(z[i], 6).alias(f"z{i}") for i in range(4)], hot, F.size(z).alias("width"))


@query(
    "f8_align",
    select(
        FEATURES,
        "select notice_id, round(z0, 6) z0, round((0 - dm) / ds, 6) z3, 0 as hot, "
        "cast(4 + (select count(*) from ty) as integer) width from fs",
        *_FILLED,
        _HOT[1],
    ),
)
def f8(spark, folder):
    rows = feature_table(spark, folder)
    state = features.fit(rows, *features.model_features(rows))
    coded = features.with_vectors(rows.drop("discount", "notice-type"), state)
    z = vector_to_array("features")
    hot = F.size(F.filter(F.slice(z, F.lit(5), F.size(z) - 4), lambda v: v == 1.0)).alias("hot")
    return coded.select(notice_id(), F.round(z[0], 6).alias("z0"), F.round(z[3], 6).alias("z3"), hot, F.size(z).alias("width"))


@query(
    "f9_fit_state",
    select(
        FEATURES,
        "select 'total-value-eur' feature, round(quantile_cont(eur, 0.5), 6) fill, round(avg(e2), 4) mean, round(stddev_pop(e2), 4) deviation from fe "
        "union all select 'total-value-eur-log', round(quantile_cont(log_eur, 0.5), 6), round(avg(log_eur), 4), round(stddev_pop(log_eur), 4) from fe "
        "union all select 'quantity', round(quantile_cont(quantity, 0.5), 6), round(avg(q2), 4), round(stddev_pop(q2), 4) from fe "
        "union all select 'discount', round(quantile_cont(discount, 0.5), 6), round(avg(d2), 4), round(stddev_pop(d2), 4) from fe",
        *_FILLED,
    ),
)
def f9(spark, folder):
    rows = feature_table(spark, folder)
    state = features.fit(rows, *features.model_features(rows))
    found = [(name, *stats) for name, stats in state.numeric.items()]
    df = spark.createDataFrame(found, "feature string, fill double, mean double, deviation double")
    return df.select("feature", F.round("fill", 6).alias("fill"), F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"))


@query(
    "p18_sample",
    select(NOTICES, "select notice_id from n order by substr(md5('42:' || notice_id), 1, 13), notice_id limit 1000"),
)
def p18(spark, folder):
    return sample_rows(tables.notices(spark, folder), S.col(KEY), 1000).select(notice_id())


def forest_inputs(spark, folder):
    rows = feature_table(spark, folder)
    return rows, features.fit(rows, *features.model_features(rows))


@query(
    "m1_forest_fit",
    select(
        NOTICES,
        "select cast(t as integer) tree, cast(least(256, (select count(*) from n)) as bigint) root_rows, "
        "cast(least(256, (select count(*) from n)) as bigint) leaf_rows, true as within_depth from range(100) as trees(t)",
    ),
)
def m1(spark, folder):
    """Per tree: every tree holds its whole sample in its leaves and stays within the depth limit."""
    rows, state = forest_inputs(spark, folder)
    trained = forest.fit_trees(features.with_codes(rows, state), KEY, first_code=len(state.numeric))
    nodes = spark.createDataFrame(trained.nodes, forest.NODE_SCHEMA)
    deepest = 2 ** (forest.depth_limit(trained.sample_rows) + 1) - 2
    return nodes.groupBy("tree").agg(
        F.max(F.when(F.col("node") == 0, F.col("size"))).alias("root_rows"),
        F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("leaf_rows"),
        (F.max("node") <= deepest).alias("within_depth"),
    )


@query("m2_forest_score")
def m2(spark, folder):
    rows, state = forest_inputs(spark, folder)
    matrix = spread(materialise(features.with_codes(rows, state), "matrix"))
    trained = forest.fit_trees(matrix, KEY, first_code=len(state.numeric))
    return matrix.select(notice_id(), F.round(forest.score_column(matrix, trained), 9).alias("score"))


@query(
    "m3_contamination",
    select(
        FLAGGED,
        "select notice_id, round(score - (select quantile_cont(score, 0.05) from c), 6) decision, "
        "coalesce(score < (select quantile_cont(score, 0.05) from c), false) is_outlier from c",
    ),
)
def m3(spark, folder):
    scored = tables.scored_notices(spark, folder)
    score = F.col("anomaly_score")
    offset = F.lit(exact_quantile(scored, score, 0.05))
    return scored.select(
        notice_id(), F.round(score - offset, 6).alias("decision"), F.coalesce(score < offset, F.lit(False)).alias("is_outlier")
    )


_ANNOTATED = (
    "select notice_id, is_outlier, case when is_outlier then 'OUTLIER' else 'NORMAL' end outlier_status, "
    "round_even(eur / top, 4) anomaly_score, '2001-01-01 00:00:00' prediction_time from c"
)


@query("m4_annotate", select(FLAGGED, _ANNOTATED))
def m4(spark, folder):
    flagged = tables.flagged_notices(spark, folder)
    beside = flagged.crossJoin(F.broadcast(flagged.agg(F.max("total-value-eur").alias("top"))))
    score = F.try_divide(S.col("total-value-eur"), F.col("top"))
    scored = forest.annotate(beside, score, F.col("is_outlier"), "2001-01-01 00:00:00")
    return scored.select(notice_id(), "is_outlier", "outlier_status", "anomaly_score", "prediction_time")


@query("c13_stamp", select(NOTICES, "select notice_id, '2001-01-01 00:00:00' prediction_time from n"))
def c13(spark, folder):
    return tables.notices(spark, folder).select(notice_id(), S.stamp("2001-01-01 00:00:00").alias("prediction_time"))


_FIXED_TREES = 8


def _fixed_forest() -> forest.ForestState:
    """Eight trees of two splits, by formula."""
    rows = []
    for t in range(_FIXED_TREES):
        rows += [(t, 0, t % 4, (t - 4) / 4, 256), (t, 1, (t + 1) % 4, (t - 3) / 8, 256 - 40 - t)]
        rows += [(t, 2, -1, 0.0, 40 + t), (t, 3, -1, 0.0, 3), (t, 4, -1, 0.0, 213 - 2 * t)]
    nodes = pd.DataFrame(rows, columns=["tree", "node", "feature", "split", "size"])
    return forest.ForestState(nodes, 256, 0.05, 42)


def _fixed_forest_sql() -> str:
    """The same trees as nested conditions."""
    path = lambda depth, size: float(depth + forest.average_path(size))
    paths = [
        f"case when z{t % 4} > {(t - 4) / 4} then {path(1, 40 + t)!r}::double "
        f"when z{(t + 1) % 4} > {(t - 3) / 8} then {path(2, 213 - 2 * t)!r}::double else {path(2, 3)!r}::double end"
        for t in range(_FIXED_TREES)
    ]
    expected = float(forest.average_path(256))
    return f"select notice_id, round(-pow(2, -(({' + '.join(paths)}) / {_FIXED_TREES}) / {expected!r}), 9) score from fs"


@query("m2_fixed_forest", select(FEATURES, _fixed_forest_sql(), *_FILLED))
def m2_fixed(spark, folder):
    rows = feature_table(spark, folder)
    coded = features.with_codes(rows, features.fit(rows, *features.model_features(rows)))
    numbers = coded.withColumn("features", F.slice("features", 1, 4))
    return numbers.select(notice_id(), F.round(forest.score_column(numbers, _fixed_forest()), 9).alias("score"))


@query("m5_kmeans_invariants", select(POINTS, "select count(*) as rows, 5::bigint as clusters, true as means, true as cost, true as good from p"))
def m5_invariants(spark, folder):
    """A fit is of all rows; centroids are means; its cost is the squared distance sum, and not above that of the region means."""
    df = materialise(points(spark, folder), "points")
    state = kmeans.fit(df, "customer")
    x, y = F.col("features")[0], F.col("features")[1]
    own = kmeans.assign(df, state).groupBy("cluster").agg(
        F.count("*").alias("rows"), F.avg(x).alias("x"), F.avg(y).alias("y"), F.sum(F.col("distance") * F.col("distance")).alias("squares")
    )
    centre = F.element_at(F.lit(state.centroids), F.col("cluster") + 1)
    mean = (F.abs(F.col("x") - centre[0]) < 0.02) & (F.abs(F.col("y") - centre[1]) < 0.02)
    plain = kmeans.inertia(df, region_centroids(spark, folder, df)).first().inertia
    return own.agg(
        F.sum("rows").alias("rows"),
        F.count("*").alias("clusters"),
        F.bool_and(mean).alias("means"),
        (F.abs(F.sum("squares") - state.inertia) < 1e-3 * state.inertia).alias("cost"),
        (F.sum("squares") <= plain).alias("good"),
    )


@query("m5_kmeans_fit")
def m5(spark, folder):
    df = points(spark, folder)
    state = kmeans.fit(df, "customer")
    sizes = kmeans.assign(df, state).groupBy("cluster").agg(
        F.count("*").alias("rows"), F.round(F.sum(F.col("distance") * F.col("distance")), 6).alias("squares")
    )
    return sizes.withColumn("inertia", F.lit(round(state.inertia, 6)))


@query("m6_assign", select(CENTROIDS, "select id as customer, cast(cluster as integer) as cluster from a"))
def m6(spark, folder):
    return kmeans.assign(*assigned(spark, folder)).select("customer", "cluster")


@query("j6_nearest_centroid", select(CENTROIDS, "select id as customer, cast(cluster as integer) as cluster, round(distance, 9) distance from a"))
def j6(spark, folder):
    return kmeans.assign(*assigned(spark, folder)).select("customer", "cluster", F.round("distance", 9).alias("distance"))


@query("m7_distance", select(CENTROIDS, "select id as customer, round(distance, 9) distance from a"))
def m7(spark, folder):
    return kmeans.assign(*assigned(spark, folder)).select("customer", F.round("distance", 9).alias("distance"))


@query(
    "m7_distance_constant",
    select(
        CENTROIDS,
        "select id as customer, cast(a.cluster as integer) as cluster, round(least_distance, 9) distance from a "
        "join (select cluster, min(distance) least_distance from d group by cluster) m on a.cluster = m.cluster",
    ),
)
def m7_constant(spark, folder):
    found = kmeans.closest_row_distances(*assigned(spark, folder))
    return found.select("customer", "cluster", F.round("distance", 9).alias("distance"))


@query(
    "m8_distance_flag",
    select(CENTROIDS, "select id as customer, distance > (select quantile_cont(distance, 0.95) from a) is_outlier from a"),
)
def m8(spark, folder):
    return kmeans.flag_far(kmeans.assign(*assigned(spark, folder))).select("customer", "is_outlier")


@query("m9_score", select(CENTROIDS, "select id as customer, round(distance / max(distance) over (), 9) anomaly_score from a"))
def m9(spark, folder):
    scored = kmeans.relative_score(kmeans.assign(*assigned(spark, folder)))
    return scored.select("customer", F.round("anomaly_score", 9).alias("anomaly_score"))


@query("m15_inertia", select(CENTROIDS, "select round(sum(distance * distance), 6) inertia, count(distinct cluster) n_clusters from a"))
def m15(spark, folder):
    return kmeans.inertia(*assigned(spark, folder)).withColumn("inertia", F.round("inertia", 6))


@query("m20_forest_run")
def m20(spark, folder):
    """Train, save, load, score: rows, outliers and score range per status."""
    rows = feature_table(spark, folder)
    path = scratch_path(spark, "forest")
    flows.train_forest(rows, KEY, path, as_of="2001-01-01 00:00:00")
    scored = flows.detect_with_forest(rows, KEY, path, as_of="2001-01-01 00:00:00")
    return scored.groupBy("outlier_status").agg(
        F.count("*").alias("rows"), F.min("anomaly_score").alias("low"), F.max("anomaly_score").alias("high")
    )


@query("m20_forest_invariants", select(FEATURES, "select count(*) as rows, true as share, true as agrees, true as in_range from f"))
def m20_invariants(spark, folder):
    """A run scores every row, flags no more than its contamination, flags by the sign of the score."""
    rows = feature_table(spark, folder)
    path = scratch_path(spark, "forest")
    flows.train_forest(rows, KEY, path, as_of="2001-01-01 00:00:00")
    scored = flows.detect_with_forest(rows, KEY, path, as_of="2001-01-01 00:00:00")
    score = F.col("anomaly_score")
    return scored.agg(
        F.count("*").alias("rows"),
        (F.count_if("is_outlier") <= 0.05 * F.count("*") + 1).alias("share"),
        # Scores are rounded, so one just below 0 shows as 0.
        F.bool_and(F.when(F.col("is_outlier"), score <= 0).otherwise(score >= 0)).alias("agrees"),
        F.bool_and(score.between(-1.0, 1.0)).alias("in_range"),
    )


@query(
    "m18_model_io",
    select(CENTROIDS, "select cast(cluster as bigint) as cluster, round(cx, 9) x, round(cy, 9) y, 'balance,nation' inputs from g"),
)
def m18(spark, folder):
    table = tables.customer_features(spark, folder)
    state = features.fit_zero_filled(table, ["balance", "nation"])
    centroids = region_centroids(spark, folder, features.with_features(table, state))
    path = models.save_clustering(spark, scratch_path(spark, "model"), state, "kmeans", "2001-01-01 00:00:00", centroids)
    loaded = models.load_clustering(spark, path)
    rows = [(i, *c, ",".join(loaded["features"].inputs)) for i, c in enumerate(loaded["kmeans"].centroids)]
    df = spark.createDataFrame(rows, "cluster bigint, x double, y double, inputs string")
    return df.select("cluster", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"), "inputs")


@query("j5_neighbours", select(oracle.POINTS, "select i as customer, count(*) >= 5 as core from n group by i", oracle.pairs(EPS).strip()))
def j5(spark, folder):
    return dbscan.core_rows(points(spark, folder), "customer", EPS, MIN_SAMPLES)


@query("w1_knn", select(POINTS, "select id as customer, cast(rank as integer) as rank, round(distance, 9) distance from kn", oracle.knn(5).strip()))
def w1(spark, folder):
    ranks = neighbours.neighbour_ranks(points(spark, folder), "customer", 5)
    return ranks.select("customer", "rank", F.round("distance", 9).alias("distance"))


SIX_EPS = 0.6


def six_points(spark, folder):
    """Customers with six standardised numbers: balance, nation, and the number, sum, maximum and minimum of their orders."""
    price = F.col("o_totalprice")
    orders = tables.table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("customer"))
    orders = orders.agg(F.count("*").alias("orders"), F.sum(price).alias("spent"), F.max(price).alias("most"), F.min(price).alias("least"))
    table = materialise(tables.customer_features(spark, folder).join(orders, "customer", "left"), "customers")
    return features.with_features(table, features.fit_zero_filled(table, ["balance", "nation", "orders", "spent", "most", "least"]))


@query(
    "w1_knn_six_features",
    select(
        oracle.SIX_POINTS,
        "select id as customer, cast(rank as integer) as rank, round(distance, 9) distance from kn",
        oracle.knn(5, oracle.SIX).strip(),
    ),
)
def w1_six(spark, folder):
    ranks = neighbours.neighbour_ranks(six_points(spark, folder), "customer", 5)
    return ranks.select("customer", "rank", F.round("distance", 9).alias("distance"))


@query(
    "m10_dbscan_six_features",
    select(oracle.dbscan(SIX_EPS, MIN_SAMPLES, oracle.SIX_POINTS, oracle.SIX), "select id as customer, cluster from lab"),
)
def m10_six(spark, folder):
    return dbscan.dbscan(six_points(spark, folder), "customer", SIX_EPS, MIN_SAMPLES)


_SAMPLED = (
    "p0 as (select c_custkey id, c_acctbal, c_nationkey, (c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over () x, "
    "(c_nationkey - avg(c_nationkey) over ()) / stddev_pop(c_nationkey) over () y from customer), "
    "p as (select id, x, y from p0)"
)
_STEPS = (
    "ks as (select distance, row_number() over (order by distance) as position from kn where rank = 5)",
    "st as (select position, distance, distance - lag(distance) over (order by position) step from ks)",
)


@query(
    "w2_diff",
    select(
        _SAMPLED,
        "select position, round(distance, 9) distance, round(step, 9) step from st",
        oracle.knn(5).strip(),
        *_STEPS,
    ),
)
def w2(spark, folder):
    steps = neighbours.sorted_kth(points(spark, folder), "customer", 5)
    return steps.select("position", F.round("distance", 9).alias("distance"), F.round("step", 9).alias("step"))


@query(
    "m13_eps_elbow",
    select(
        _SAMPLED,
        "select round(distance, 9) eps from st where step is not null order by step desc, position limit 1",
        oracle.knn(5).strip(),
        *_STEPS,
    ),
)
def m13(spark, folder):
    return neighbours.elbow_eps(points(spark, folder), "customer", 5).select(F.round("eps", 9).alias("eps"))


@query(
    "w3_renumber",
    select(NOTICES, "select notice_id, notice_type, dense_rank() over (order by notice_type) - 1 as number from n"),
)
def w3(spark, folder):
    raw = tables.notices(spark, folder).select(notice_id(), S.col("notice-type").alias("notice_type"))
    return raw.join(dbscan.numbered(raw, "notice_type", "number"), "notice_type")


@query("m10_dbscan", select(oracle.dbscan(EPS, MIN_SAMPLES), "select id as customer, cluster from lab"))
def m10(spark, folder):
    return dbscan.dbscan(points(spark, folder), "customer", EPS, MIN_SAMPLES)


_KNN_SCORE = "ks as (select id, avg(distance) m from kn group by id)"


@query(
    "m11_knn_score",
    select(
        POINTS,
        "select id as customer, round(m, 9) mean_distance, round(m / max(m) over (), 9) anomaly_score from ks",
        oracle.knn(5).strip(),
        _KNN_SCORE,
    ),
)
def m11(spark, folder):
    scores = neighbours.knn_scores(points(spark, folder), "customer", MIN_SAMPLES)
    return scores.select("customer", *[F.round(c, 9).alias(c) for c in ("mean_distance", "anomaly_score")])


_NOISE_SCORED = (
    "select id as customer, lab.cluster, lab.cluster = -1 as is_outlier, "
    "round(case when lab.cluster = -1 then 1.0 else m / (select max(m) from ks) end, 9) anomaly_score from lab join ks using (id)"
)


@query(
    "m12_noise_override",
    select(oracle.dbscan(EPS, MIN_SAMPLES), _NOISE_SCORED, oracle.knn(5).strip(), _KNN_SCORE),
)
def m12(spark, folder):
    df = materialise(points(spark, folder), "points")
    labels = dbscan.dbscan(df, "customer", EPS, MIN_SAMPLES)
    scores = neighbours.knn_scores(df, "customer", MIN_SAMPLES)
    found = dbscan.noise_override(dbscan.flag_noise(labels.join(scores, "customer")))
    return found.select("customer", "cluster", "is_outlier", F.round("anomaly_score", 9).alias("anomaly_score"))


@query(
    "m14_silhouette",
    select(
        POINTS,
        "select round(v, 9) silhouette_score from sil",
        "rl as (select id, x, y, n_regionkey cluster from p join nation on nation = n_nationkey)",
        oracle.silhouette("rl").strip(),
    ),
)
def m14(spark, folder):
    nation = tables.table(spark, folder, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("cluster"))
    labelled = points(spark, folder).join(nation, "nation")
    return quality.silhouette(labelled).select(F.round("silhouette_score", 9).alias("silhouette_score"))


@query(
    "m16_cluster_counts",
    select(
        oracle.dbscan(EPS, MIN_SAMPLES),
        "select count(distinct case when cluster >= 0 then cluster end) n_clusters, count(*) filter (cluster = -1) n_outliers, "
        "count(*) total_records, round(count(*) filter (cluster = -1) * 100.0 / count(*), 6) outlier_percentage from lab",
    ),
)
def m16(spark, folder):
    counts = dbscan.cluster_counts(dbscan.dbscan(points(spark, folder), "customer", EPS, MIN_SAMPLES))
    return counts.withColumn("outlier_percentage", F.round("outlier_percentage", 6))


@query(
    "m17_cluster_eval",
    select(
        oracle.dbscan(EPS, MIN_SAMPLES),
        "select (select count(distinct case when cluster >= 0 then cluster end) from lab) n_clusters, "
        "(select count(*) from lab where cluster = -1) n_outliers, "
        "(select round(count(*) filter (cluster = -1) * 100.0 / count(*), 6) from lab) outlier_percentage, "
        "round(v, 9) silhouette_score, cast(0.05 as double) eps, cast(5 as bigint) min_samples from sil",
        "kl as (select * from lab where cluster >= 0)",
        oracle.silhouette("kl").strip(),
    ),
)
def m17(spark, folder):
    record = quality.dbscan_record(materialise(points(spark, folder), "points"), "customer", EPS, MIN_SAMPLES)
    return record.withColumns({c: F.round(c, d) for c, d in (("outlier_percentage", 6), ("silhouette_score", 9))})


@query("m17_kmeans_eval", select(
    CENTROIDS,
    "select round(v, 9) silhouette_score, (select round(sum(distance * distance), 6) from a) inertia, cast(5 as bigint) n_clusters from sil",
    oracle.silhouette("a").strip(),
))
def m17_kmeans(spark, folder):
    df, state = assigned(spark, folder)
    df = materialise(df, "points")
    state.inertia = kmeans.inertia(df, state).first()["inertia"]
    record = quality.kmeans_record(df, state)
    return record.withColumns({c: F.round(c, d) for c, d in (("inertia", 6), ("silhouette_score", 9))})


@query(
    "m19_cluster_run",
    select(oracle.dbscan(EPS, MIN_SAMPLES), _NOISE_SCORED, oracle.knn(5).strip(), _KNN_SCORE),
)
def m19(spark, folder):
    found = flows.cluster_run(tables.customer_features(spark, folder), "customer", "dbscan", EPS, MIN_SAMPLES)
    return found.select("customer", "cluster", "is_outlier", F.round("anomaly_score", 9).alias("anomaly_score"))


@query("m19_kmeans_invariants", select(POINTS, "select count(*) as rows, 5::bigint as clusters, true as share, true as in_range from p"))
def m19_kmeans_invariants(spark, folder):
    """A KMeans run keeps every row and flags at most a twentieth of them."""
    found = flows.cluster_run(tables.customer_features(spark, folder), "customer", "kmeans")
    return found.agg(
        F.count("*").alias("rows"),
        F.count_distinct("cluster").alias("clusters"),
        (F.count_if("is_outlier") <= 0.05 * F.count("*") + 1).alias("share"),
        F.bool_and(F.col("anomaly_score").between(0.0, 1.0)).alias("in_range"),
    )


@query(
    "m19_null_ids",
    select(
        oracle.dbscan(EPS, MIN_SAMPLES),
        "select case when p.id % 7 = 0 then null else p.id end as customer, lab.cluster = -1 as is_outlier from p join lab using (id)",
    ),
)
def m19_null_ids(spark, folder):
    """Rows whose id is null are clustered like any others, and none is lost."""
    rows = tables.customer_features(spark, folder)
    rows = rows.withColumn("customer", F.when(F.col("customer") % 7 != 0, F.col("customer")))
    found = flows.cluster_run(rows, "customer", "dbscan", EPS, MIN_SAMPLES)
    return found.select("customer", "is_outlier")


@query("m19_kmeans_run")
def m19_kmeans(spark, folder):
    """Rows, outliers and score range per cluster of a KMeans run."""
    found = flows.cluster_run(tables.customer_features(spark, folder), "customer", "kmeans")
    return found.groupBy("cluster").agg(
        F.count("*").alias("rows"), F.count_if("is_outlier").alias("outliers"), F.round(F.max("anomaly_score"), 6).alias("high")
    )
