"""KMeans: fit, assignment, distance flags and scores.

All starts of a fit advance together: an iteration is one pass over the table, in which each task adds up, for every start
and cluster, the rows that are nearest to its centroid. Coordinates are rounded to a grid of some 40 binary digits and
added as whole numbers, so sums, and with them the model, do not depend on how rows are dealt over tasks.
"""

import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenderlens.functions import scalars as S
from tenderlens.functions.quantiles import exact_quantile
from tenderlens.session import materialise, spread

# Distinct vectors that initial centroids are drawn from.
SEEDING_ROWS = 20_000
GRID_BITS = 40
# Rows whose whole numbers of GRID_BITS are added in 64 bits.
BLOCK_ROWS = 1 << 14


@dataclass
class KMeansState:
    """Centroids by cluster id, and the squared distance sum over the training rows."""

    centroids: list[list[float]]
    inertia: float | None = None

    def to_dict(self):
        return asdict(self)


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, axis by axis: a row's do not depend on the rows beside it."""
    total = np.zeros((len(x), len(centroids)))
    for j in range(x.shape[1]):
        gap = x[:, j][:, None] - centroids[:, j][None, :]
        total += gap * gap
    return total


def seeds(x: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` rows, each drawn by its weight times the squared distance to the nearest one drawn before."""
    near, chosen = np.full(len(x), 1.0), []
    while len(chosen) < min(k, len(x)):
        shares = near * weights
        if not shares.any():
            break
        chosen.append(int(np.searchsorted(np.cumsum(shares), rng.random() * shares.sum(), "right").clip(max=len(x) - 1)))
        last = _squares(x, x[chosen[-1:]])[:, 0]
        near = last if len(chosen) == 1 else np.minimum(near, last)
    return x[chosen]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


_SUMS = "start int, cluster int, axis int, value decimal(38,0)"


def _pass(vectors: DataFrame, starts: dict[int, np.ndarray], shifts: list[int], cost_shift: int) -> dict[tuple[int, int, int], int]:
    """One pass: (start, cluster, axis) to a sum on the grid; axis -1 has the rows, -2 the squared distances."""
    grid = np.ldexp(1.0, np.array(shifts))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x, weight = _matrix(part.column(0)), part.column(1).to_numpy()
                whole = np.rint(x * grid).astype(np.int64)
                for start, centroids in starts.items():
                    squares = _squares(x, centroids)
                    nearest = squares.argmin(axis=1)
                    cost = np.rint(np.ldexp(squares[np.arange(len(x)), nearest], cost_shift)).astype(np.int64)
                    for cluster in np.unique(nearest):
                        own = nearest == cluster
                        # Weights can be large, so products of them are added as Python's whole numbers.
                        single, many = own & (weight == 1), np.flatnonzero(own & (weight > 1))
                        values = [*whole[single].sum(axis=0).tolist(), int(single.sum()), int(cost[single].sum())]
                        for row in many:
                            w = int(weight[row])
                            values = [v + w * int(n) for v, n in zip(values, [*whole[row], 1, cost[row]])]
                        for axis, value in zip([*range(x.shape[1]), -1, -2], values):
                            key = (start, int(cluster), axis)
                            sums[key] = sums.get(key, 0) + value
        keys = list(zip(*sums)) or [(), (), ()]
        arrays = [pa.array(values, pa.int32()) for values in keys]
        arrays.append(pa.array([Decimal(v) for v in sums.values()], pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays(arrays, names=["start", "cluster", "axis", "value"])

    found = vectors.mapInArrow(add, _SUMS).groupBy("start", "cluster", "axis").agg(F.sum("value").alias("value"))
    # One row per start, cluster and axis.
    return {(r.start, r.cluster, r.axis): int(r.value) for r in found.collect()}


def fit(df: DataFrame, key: str, k: int = 5, seed: int = 42, n_init: int = 10, max_iter: int = 300, tol: float = 1e-4) -> KMeansState:
    """The best of ``n_init`` starts by the squared distance sum, the first on a tie.

    Each start draws its first centroids from a bounded hash sample of distinct vectors and then moves over all rows,
    until its centroids move by less than ``tol`` times the mean variance, squared, or for ``max_iter`` passes. A seed gives
    one model on any cluster. There are fewer centroids than ``k`` if there are fewer distinct vectors.
    """
    vectors = df.groupBy(F.col("features").alias("x")).agg(F.count("*").alias("weight"))
    vectors = spread(materialise(vectors, "vectors")).persist()
    try:
        shape = vectors.select(F.size("x").alias("dims")).first()
        if shape is None:
            raise ValueError("no rows to fit on")
        axes = [F.col("x")[j] for j in range(shape.dims)]
        weight = F.sum("weight")
        stats = vectors.agg(weight.alias("rows"), *[e for x in axes for e in (F.max(F.abs(x)), F.sum(x * F.col("weight")), F.sum(x * x * F.col("weight")))]).first()
        rows, tops, firsts, seconds = stats[0], stats[1::3], stats[2::3], stats[3::3]
        shifts = [GRID_BITS - math.frexp(top)[1] for top in tops]
        # No row is farther from a centroid than twice the farthest corner.
        cost_shift = GRID_BITS - math.frexp(4 * sum(top * top for top in tops))[1]
        enough = tol * sum(max(b / rows - (a / rows) ** 2, 0.0) for a, b in zip(firsts, seconds)) / max(len(tops), 1)

        drawn = vectors.orderBy(F.xxhash64(F.lit(seed), "x")).limit(SEEDING_ROWS).collect()
        x, weights = np.array([r.x for r in drawn]), np.array([float(r.weight) for r in drawn])
        starts = {n: seeds(x, weights, k, np.random.default_rng([seed, n])) for n in range(n_init)}
        open_, costs = set(starts), {}
        for _ in range(max_iter):
            if not open_:
                break
            sums = _pass(vectors, {n: starts[n] for n in sorted(open_)}, shifts, cost_shift)
            for n in sorted(open_):
                moved = starts[n].copy()
                for c in range(len(moved)):
                    many = sums.get((n, c, -1), 0)
                    for j, shift in enumerate(shifts if many else ()):
                        moved[c, j] = math.ldexp(sums[n, c, j] / many, -shift)
                if ((moved - starts[n]) ** 2).sum() <= enough:
                    open_.discard(n)
                starts[n] = moved
        sums = _pass(vectors, starts, shifts, cost_shift)
        costs = {n: sum(value for (start, _, axis), value in sums.items() if start == n and axis == -2) for n in starts}
        best = min(costs, key=lambda n: (costs[n], n))
        return KMeansState(starts[best].tolist(), math.ldexp(costs[best], -cost_shift))
    finally:
        vectors.unpersist()


def _coordinates(width: int) -> list[Column]:
    return [F.col("features")[i] for i in range(width)]


def centroid_distances(state: KMeansState) -> list[Column]:
    """The distance to each centroid; k literal vectors, so assignment needs no join."""
    return [S.distance(_coordinates(len(c)), [F.lit(v) for v in c]) for c in state.centroids]


def assign(df: DataFrame, state: KMeansState) -> DataFrame:
    """Nearest centroid (lowest id on a tie) and the distance to it."""
    distances = df.withColumn("_d", F.array(*centroid_distances(state)))
    nearest = distances.withColumn("distance", F.array_min("_d"))
    return nearest.withColumn("cluster", F.array_position("_d", F.col("distance")).cast("int") - 1).drop("_d")


def closest_row_distances(df: DataFrame, state: KMeansState) -> DataFrame:
    """Like :func:`assign`, but with each cluster's smallest centroid distance over *all* rows.

    A literal variant of the distance rule under which every row of a cluster gets one
    constant: the k minima come from a single aggregate.
    """
    minima = df.agg(*[F.min(d).alias(f"d{i}") for i, d in enumerate(centroid_distances(state))]).first()
    constants = F.array(*[F.lit(v).cast("double") for v in minima])
    return assign(df, state).withColumn("distance", constants[F.col("cluster")])


def flag_far(df: DataFrame, probability: float = 0.95) -> DataFrame:
    """Outliers: distance above its own percentile in this table."""
    return df.withColumn("is_outlier", S.above(F.col("distance"), exact_quantile(df, F.col("distance"), probability)))


def relative_score(df: DataFrame, column: str = "distance") -> DataFrame:
    """Score: value over the highest value, null where that is 0."""
    top = F.broadcast(df.agg(F.max(column).alias("_top")))
    return df.crossJoin(top).withColumn("anomaly_score", F.try_divide(column, "_top")).drop("_top")


def inertia(df: DataFrame, state: KMeansState) -> DataFrame:
    """Squared distance sum and number of clusters."""
    assigned = assign(df, state)
    return assigned.agg(
        F.sum(F.col("distance") * F.col("distance")).alias("inertia"), F.count_distinct("cluster").alias("n_clusters")
    )


def detect(df: DataFrame, state: KMeansState, constant_distance: bool = False) -> DataFrame:
    """cluster, distance, is_outlier and anomaly_score for rows with features."""
    placed = closest_row_distances(df, state) if constant_distance else assign(df, state)
    return relative_score(flag_far(placed))
