"""Quality of a clustering: exact Euclidean silhouette and the evaluation records.

The mean distance of a row to a cluster is never below its distance to the cluster's centroid. A row is therefore
compared with its own cluster and with others from the nearest centroid on, in rounds, until the next centroid is no
nearer than the smallest mean found; all further clusters are left out without loss. Sums of distances come from boxes
(``sums``) on up to three axes; on more of them every row meets all rows of the clusters it visits.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tenderlens.operators import dbscan, kmeans
from tenderlens.operators.neighbours import arrow_matrix
from tenderlens.operators.sums import MOST_AXES, ClusterSums, distances, matrix, weighted_sums
from tenderlens.session import identified, materialise

# Members of a cluster, and rows that are compared with them, in one group.
BLOCK_ROWS = 16_384
# Other clusters that a row visits in its first round; each round visits four times as many.
FIRST_VISITED = 2
# Coordinates of centroids that are held at once.
CENTROID_NUMBERS = 1 << 20


def distance_sums(visits: DataFrame, vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(v, other, total): summed distance of each visiting vector (v, x, other) to all rows of cluster ``other``.

    The members and the visitors of a cluster are dealt into blocks, and each pair of blocks is one group, which
    adds up tile by tile: no row pair is ever a row, and no cluster or visitor has to fit in a task.
    """
    blocks = F.ceil(F.count("*") / block_rows)
    members = vectors.groupBy(F.col("cluster").alias("other")).agg(blocks.alias("member_blocks"))
    visitors = visits.groupBy("other").agg(blocks.alias("visitor_blocks"))
    cuts = materialise(members.join(visitors, "other"), "cuts")

    def dealt(rows, own, theirs):
        block = F.pmod(F.xxhash64("v"), F.col(f"{own}_blocks")).alias(own)
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{theirs}_blocks") - 1)).alias(theirs)
        return rows.join(cuts, "other").select(*rows.columns, block, copies)

    left = dealt(visits.select("v", "x", "other"), "visitor", "member")
    right = dealt(vectors.select("v", "x", "weight", F.col("cluster").alias("other")), "member", "visitor")
    keys = ["other", "member", "visitor"]

    def block_pair(asking, there):
        if not len(asking) or not len(there):
            return pd.DataFrame({"v": [], "other": [], "total": []})
        one, two, weights = matrix(asking.x), matrix(there.x), there.weight.to_numpy().astype(float)
        return pd.DataFrame({"v": asking.v, "other": asking.other, "total": weighted_sums(one, two, weights)})

    sums = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(block_pair, "v bigint, other bigint, total double")
    return sums.groupBy("v", "other").agg(F.sum("total").alias("total"))


def _centroids(vectors: DataFrame) -> DataFrame:
    """(cluster, size, centre)."""
    values = vectors.select("cluster", "weight", F.posexplode("x").alias("axis", "value"))
    means = values.groupBy("cluster", "axis").agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("mean"), F.sum("weight").alias("size"))
    ordered = F.array_sort(F.collect_list(F.struct("axis", "mean")))
    return means.groupBy("cluster").agg(F.max("size").alias("size"), F.transform(ordered, lambda e: e["mean"]).alias("centre"))


def _blocks(centroids: DataFrame, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(clusters, centres), some at a time."""
    held, most = [], max(1, CENTROID_NUMBERS // max(dims, 1))
    for row in centroids.select("cluster", "centre").orderBy("cluster").toLocalIterator():
        held.append(row)
        if len(held) == most:
            yield np.array([r.cluster for r in held]), np.array([r.centre for r in held])
            held = []
    if held:
        yield np.array([r.cluster for r in held]), np.array([r.centre for r in held])


def _nearest_open(far: np.ndarray, names: np.ndarray, open_: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, far, names): per row the ``many`` nearest open columns by distance and name, one row after the other."""
    if many < far.shape[1]:
        last = np.partition(np.where(open_, far, np.inf), many - 1, axis=1)[:, many - 1 : many]
        open_ = open_ & (far <= last)
    rows, columns = np.nonzero(open_)
    order = np.lexsort((names[columns], far[rows, columns], rows))
    counts = np.bincount(rows, minlength=len(far))
    # Columns as far as the last one wanted are too many.
    kept = order[np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) < many]
    return np.cumsum(np.minimum(counts, many)), far[rows[kept], columns[kept]], names[columns[kept]]


_STATE = "v bigint, x array<double>, cluster bigint, weight bigint, best double, after_far double, after_cluster bigint"


def _next_visits(state: DataFrame, centroids: DataFrame, dims: int, many: int) -> DataFrame:
    """(.., visit): up to ``many`` clusters per row, the nearest centroids not visited yet and nearer than ``best``.

    Centroids are in order of distance and cluster; ``after_far`` and ``after_cluster`` name the last one visited.
    """
    kind = "array<struct<far:double,cluster:bigint>>"
    found = state.withColumn("visit", F.array().cast(kind))
    for names, centres in _blocks(centroids, dims):

        def near(batches, names=names, centres=centres):
            for batch in batches:
                step = max(1, CENTROID_NUMBERS // len(names))
                for at in range(0, batch.num_rows, step):
                    part = batch.slice(at, step)
                    # A little less than the distance, so that rounding never leaves a cluster out.
                    far = distances(arrow_matrix(part.column("x")), centres) * (1 - 1e-9)
                    best, last, own, after = (part.column(c).to_numpy(zero_copy_only=False)[:, None] for c in ("best", "after_far", "cluster", "after_cluster"))
                    open_ = (far < best) & ((far > last) | ((far == last) & (names > after))) & (names != own)
                    ends, *new = _nearest_open(far, names, open_, many)
                    lists = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.StructArray.from_arrays(map(pa.array, new), ["far", "cluster"]))
                    yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "new"])

        columns = _STATE + f", visit {kind}"
        found = found.mapInArrow(near, f"{columns}, new {kind}")
        found = found.withColumn("visit", F.slice(F.array_sort(F.concat("visit", "new")), 1, many)).drop("new")
    return found


def silhouette(df: DataFrame, block_rows: int = BLOCK_ROWS, first: int = FIRST_VISITED, compared: list | None = None) -> DataFrame:
    """One row: the mean silhouette of rows with ``features`` and ``cluster``, 0 below two clusters.

    Rows alone in their cluster score 0. Equal rows of a cluster are merged and weighted. ``compared`` gets the
    number of pairs of a vector and a cluster that are looked at, by round.
    """
    merged = df.groupBy(F.col("cluster").cast("bigint").alias("cluster"), F.col("features").alias("x")).agg(F.count("*").alias("weight"))
    vectors = materialise(merged.withColumn("v", F.monotonically_increasing_id()), "vectors")
    centroids = materialise(_centroids(vectors), "centroids")
    sizes = centroids.select(F.col("cluster").alias("other"), "size")
    shape = vectors.select(F.size("x").alias("dims")).first()
    if shape is None or centroids.count() < 2:
        return df.sparkSession.createDataFrame([(0.0,)], "silhouette_score double")

    nothing = [F.lit(v).cast(kind).alias(name) for v, kind, name in ((float("inf"), "double", "best"), (-1.0, "double", "after_far"), (-1, "bigint", "after_cluster"))]
    boxes = ClusterSums(vectors, vectors.count()) if shape.dims <= MOST_AXES else None
    state, own, many = vectors.select("v", "x", "cluster", "weight", *nothing), None, first
    done = []
    while True:
        state = materialise(_next_visits(state, centroids, shape.dims, many), "visits")
        done.append(state.filter(F.size("visit") == 0).select("v", "weight", "best"))
        state = state.filter(F.size("visit") > 0)
        visits = state.select("v", "x", F.explode("visit.cluster").alias("other"))
        if own is None:
            visits = visits.unionAll(vectors.select("v", "x", F.col("cluster").alias("other")))
        elif state.isEmpty():
            break
        if compared is not None:
            compared.append(visits.count())
        sums = materialise(boxes.of(visits) if boxes else distance_sums(visits, vectors, block_rows), "sums")
        if own is None:
            own = sums
        means = sums.join(sizes, "other").select("v", "other", (F.col("total") / F.col("size")).alias("mean"))
        met = state.join(means, "v").filter("other <> cluster")
        last = F.element_at("visit", -1)
        found = met.groupBy("v").agg(F.min("mean").alias("mean"))
        moved = state.join(found, "v").withColumns({"best": F.least("best", "mean"), "after_far": last["far"], "after_cluster": last["cluster"]})
        # A row that found fewer clusters than it could visit has seen all that are near enough.
        done.append(moved.filter(F.size("visit") < many).select("v", "weight", "best"))
        state, many = moved.filter(F.size("visit") >= many).drop("visit", "mean"), 4 * many
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionAll(more)
    own = own.join(vectors.select("v", "cluster"), "v").filter("other = cluster").join(sizes, "other")
    own = own.select("v", F.try_divide("total", F.col("size") - 1).alias("a"))
    a, b = F.col("a"), F.col("best")
    score = F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))
    mean = F.sum(score * F.col("weight")) / F.sum("weight")
    return rows.join(own, "v").agg(mean.alias("silhouette_score"))


def kmeans_record(df: DataFrame, state: kmeans.KMeansState) -> DataFrame:
    """Silhouette on ``df``, inertia of the training rows, number of clusters."""
    scored = silhouette(kmeans.assign(df, state))
    return scored.select(
        "silhouette_score",
        F.lit(state.inertia).cast("double").alias("inertia"),
        F.lit(len(state.centroids)).cast("bigint").alias("n_clusters"),
    )


def dbscan_record(df: DataFrame, key: str, eps: float, min_samples: int) -> DataFrame:
    """Cluster and noise counts and the silhouette of the rows that are not noise; clusters ``df`` anew."""
    rows = identified(df.select(key, "features"), key)
    labels = dbscan.dbscan(rows, "_identity", eps, min_samples)
    labelled = materialise(rows.join(labels, "_identity").drop("_identity"), "labelled")
    counts = dbscan.cluster_counts(labelled)
    scored = silhouette(labelled.filter("cluster >= 0"))
    return counts.crossJoin(F.broadcast(scored)).select(
        "n_clusters",
        "n_outliers",
        "outlier_percentage",
        "silhouette_score",
        F.lit(float(eps)).alias("eps"),
        F.lit(min_samples).cast("bigint").alias("min_samples"),
    )
