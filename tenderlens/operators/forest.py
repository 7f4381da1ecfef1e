"""Isolation forest: sampled trees built in parallel, scored in Arrow batches.

Every tree learns from at most 256 rows, so the whole forest is a node table of at
most trees * 511 rows whatever the size of the training table. Only that table goes
to the driver and to the executors.

A row has its numbers and one code per text column. A split on a code asks whether a row has it, as a split on that
category's 0/1 column would: each category that some rows of a node have and others have not counts as one feature.
"""

import math
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderlens.functions import scalars as S
from tenderlens.functions.quantiles import exact_quantile, sample_rows
from tenderlens.operators.features import FeatureState, with_codes
from tenderlens.session import materialise, spread

TREES = 100
SAMPLE_ROWS = 256
_OVERSAMPLE = 1.5
# Hashes of repeated rows that are sent to all tasks.
MOST_BROADCAST = 100_000
NODE_SCHEMA = "tree int, node int, feature int, split double, size bigint"


@dataclass
class ForestState:
    """Trees in heap order (children of node i are 2i+1 and 2i+2), sample size, threshold.

    Features from ``first_code`` on are codes: rows equal to the split go right. None: there are no codes.
    """

    nodes: pd.DataFrame
    sample_rows: int
    contamination: float
    seed: int
    offset: float | None = None
    first_code: int | None = None

    def to_dict(self):
        data = asdict(self)
        del data["nodes"]
        return data


def average_path(n):
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    usual = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, usual))


def depth_limit(rows: int) -> int:
    return math.ceil(math.log2(max(rows, 2)))


def tree_samples(df: DataFrame, key: str, trees: int, rows: int, total: int, seed: int) -> DataFrame:
    """(tree, place, features): ``rows`` rows per tree without replacement.

    Every tree draws on its own, by hashes of key and features, so a draw does not depend on
    partitioning. Rows alike in both would be drawn together or not at all; those, and only
    those, are told apart by their place in ``df``, which must be a written table.
    """
    alike = F.xxhash64(F.col(f"`{key}`"), "features")
    known = df.select(F.col(f"`{key}`").alias("_key"), "features", alike.alias("_alike"), F.monotonically_increasing_id().alias("_row"))
    # Hashes alone are shuffled, and the rows only if very many of them are alike.
    again = materialise(known.groupBy("_alike").agg(F.count("*").alias("_many")).filter("_many > 1"), "alike")
    again = F.broadcast(again) if again.count() <= MOST_BROADCAST else again
    known = known.join(again, "_alike", "left").withColumn("_row", F.when(F.col("_many") > 1, F.col("_row")).otherwise(0))

    def unit(tree):
        return F.shiftrightunsigned(F.xxhash64("_alike", "_row", F.lit(seed), tree), 11) / float(2**53)

    share = min(1.0, _OVERSAMPLE * rows / total)
    # Compiled as a loop over trees that ends in the filter; a function over an array of trees would be interpreted.
    offered = known.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn("place", unit(F.col("tree")))
    drawn = offered.filter(F.col("place") < share)
    order = Window.partitionBy("tree").orderBy("place", "_key", "_row")
    numbered = drawn.withColumn("number", F.row_number().over(order)).filter(F.col("number") <= rows)
    return numbered.select("tree", F.col("number").alias("place"), "features")


def grow(points: np.ndarray, rng: np.random.Generator, limit: int, first_code: int | None = None):
    """Nodes (node, feature, split, size) of one tree: a random varying feature and a uniform split per node."""
    numbers = points.shape[1] if first_code is None else first_code
    nodes = []
    stack = [(0, 0, np.arange(len(points)))]
    while stack:
        node, depth, at = stack.pop()
        own = points[at]
        low, high = own[:, :numbers].min(axis=0), own[:, :numbers].max(axis=0)
        varying = [(int(f), None) for f in np.flatnonzero(high > low)]
        for column in range(numbers, points.shape[1]):
            present = np.unique(own[:, column])
            if len(present) > 1:
                varying += [(column, code) for code in present]
        if depth >= limit or len(at) <= 1 or not varying:
            nodes.append((node, -1, 0.0, len(at)))
            continue
        feature, code = varying[rng.integers(len(varying))]
        if code is None:
            split = rng.uniform(low[feature], high[feature])
            if split >= high[feature]:
                split = low[feature]
            lower = own[:, feature] <= split
        else:
            split, lower = code, own[:, feature] != code
        nodes.append((node, feature, float(split), len(at)))
        stack.append((2 * node + 2, depth + 1, at[~lower]))
        stack.append((2 * node + 1, depth + 1, at[lower]))
    return nodes


def fit_trees(
    df: DataFrame,
    key: str,
    trees: int = TREES,
    rows: int = SAMPLE_ROWS,
    contamination: float = 0.05,
    seed: int = 42,
    first_code: int | None = None,
) -> ForestState:
    """Grow the trees from rows with ``features``, codes from place ``first_code`` on; :func:`set_offset` sets the threshold."""
    total = df.count()
    if not total:
        raise ValueError("no rows to train on")
    rows = min(rows, total)
    limit = depth_limit(rows)
    # At most ``trees`` * ``rows`` rows from here on.
    samples = materialise(tree_samples(df, key, trees, rows, total, seed), "samples")

    def build(group):
        group = group.sort_values("place")
        tree = int(group.tree.iloc[0])
        grown = grow(np.vstack(group.features.to_numpy()), np.random.default_rng([seed, tree]), limit, first_code)
        frame = pd.DataFrame(grown, columns=["node", "feature", "split", "size"])
        frame.insert(0, "tree", tree)
        return frame

    sizes = samples.groupBy("tree").agg(F.count("*").alias("rows")).filter(F.col("rows") == rows).count()
    if sizes < trees:
        raise RuntimeError(f"only {sizes} of {trees} trees got their {rows} rows")

    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    nodes = samples.repartition(tasks, "tree").groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    return ForestState(nodes, rows, contamination, seed, first_code=first_code)


def _tables(nodes: pd.DataFrame, depth: int):
    """Per tree arrays by heap position down to ``depth``: feature, split, and path length at the bottom.

    A leaf above the bottom sends every row left, and its path length waits at its
    leftmost bottom position, so a descent is the same fixed number of steps for all rows.
    """
    trees, slots = int(nodes.tree.max()) + 1, 2 ** (depth + 1) - 1
    feature = np.zeros((trees, slots), dtype=np.int64)
    split = np.full((trees, slots), np.inf)
    path = np.zeros((trees, slots))
    inner = nodes[nodes.feature >= 0]
    feature[inner.tree, inner.node] = inner.feature
    split[inner.tree, inner.node] = inner.split
    leaves = nodes[nodes.feature < 0]
    node = leaves.node.to_numpy()
    level = np.floor(np.log2(node + 1)).astype(int)
    bottom = (node + 1) * 2 ** (depth - level) - 1
    path[leaves.tree, bottom] = level + average_path(leaves["size"])
    return depth, feature, split, path


def mean_path(points: np.ndarray, tables, first_code: int | None = None) -> np.ndarray:
    depth, feature, split, path = tables
    flat, base = points.ravel(), np.arange(len(points)) * points.shape[1]
    total = np.zeros(len(points))
    for tree_feature, tree_split, tree_path in zip(feature, split, path):
        at = np.zeros(len(points), dtype=np.int64)
        coded = first_code is not None and (tree_feature >= first_code).any()
        for _ in range(depth):
            own = tree_feature.take(at)
            value, against = flat.take(base + own), tree_split.take(at)
            right = value > against
            if coded:
                right = np.where(own >= first_code, value == against, right)
            at = 2 * at + 1 + right
        total += tree_path.take(at)
    return total / len(feature)


def score_column(df: DataFrame, state: ForestState) -> Column:
    """-2 ** (-mean path / expected path): lower is more anomalous."""
    tables = df.sparkSession.sparkContext.broadcast(_tables(state.nodes, depth_limit(state.sample_rows)))
    first_code = state.first_code
    expected = float(average_path(state.sample_rows)) or 1.0

    @F.arrow_udf("double")
    def score(features: pa.Array) -> pa.Array:
        if not len(features):
            return pa.array([], pa.float64())
        points = features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), -1)
        return pa.array(-np.exp2(-mean_path(points, tables.value, first_code) / expected))

    return score(F.col("features"))


def set_offset(df: DataFrame, state: ForestState) -> ForestState:
    """Threshold: the contamination quantile of the scores of the training rows."""
    state.offset = exact_quantile(df, score_column(df, state), state.contamination)
    return state


def decide(df: DataFrame, state: ForestState) -> DataFrame:
    """Adds ``decision``: the score less the threshold; negative means outlier."""
    return df.withColumn("decision", score_column(df, state) - F.lit(state.offset))


def annotate(df: DataFrame, score: Column, flag: Column, as_of: str | None = None) -> DataFrame:
    """The scored table: flag, label, score rounded to 4 places, prediction time."""
    return df.withColumn("is_outlier", flag).withColumns(
        {
            "outlier_status": S.status_label(F.col("is_outlier")),
            "anomaly_score": S.round_score(score),
            "prediction_time": S.stamp(as_of),
        }
    )


def train(
    df: DataFrame,
    key: str,
    features: FeatureState,
    contamination: float = 0.05,
    sample_size: int | None = None,
    trees: int = TREES,
    seed: int = 42,
) -> ForestState:
    """Fit trees and threshold on ``df``, or on exactly ``sample_size`` of its rows."""
    matrix = with_codes(df, features).select(F.col(f"`{key}`").alias(key), "features")
    if sample_size:
        matrix = sample_rows(matrix, F.col(f"`{key}`"), sample_size, seed)
    matrix = spread(materialise(matrix, "matrix"))
    return set_offset(matrix, fit_trees(matrix, key, trees, SAMPLE_ROWS, contamination, seed, len(features.numeric)))


def predict(df: DataFrame, features: FeatureState, state: ForestState, as_of: str | None = None) -> DataFrame:
    scored = decide(with_codes(df, features), state)
    return annotate(scored, F.col("decision"), F.col("decision") < 0, as_of).drop("features", "decision")
