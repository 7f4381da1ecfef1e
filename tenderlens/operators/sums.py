"""Sums of distances from rows to all rows of a cluster, without comparing all pairs.

The distance to a row is smooth away from that row. Rows of a cluster that lie in one box are therefore replaced, for all
that ask from afar, by weighted nodes of that box (Chebyshev nodes, the weights are those of polynomial interpolation):
with ``NODES`` per axis and at least ``APART`` half widths between, sums agree with those over the rows to some twelve
digits. Boxes are those of a kd partition: its leaves, and the inner nodes of its tree. A leaf of asking rows takes
the largest boxes that are far enough, and the rows themselves of the leaves beside it, so each row meets a
number of others that grows with the logarithm of the table. An axis on which a box has no width needs one node.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tenderlens.operators.neighbours import TREE_LEAVES, SpacePartition, arrow_matrix
from tenderlens.session import materialise

NODES = 14
APART = 3.0
# Axes up to which boxes save work: there are NODES ** axes nodes in one.
MOST_AXES = 3
LEAF_ROWS = 1024
TILE_ROWS = 1024
ASKING_TILE = 64
# Asking leaves for which one task looks through a cluster's boxes.
ASKING_LEAVES = 512

_ANGLES = (np.arange(NODES) + 0.5) * np.pi / NODES
_DUAL = np.cos(np.outer(np.arange(NODES), _ANGLES)) * np.where(np.arange(NODES) == 0, 1, 2)[:, None] / NODES


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        gap = a[:, i][:, None] - b[:, i][None, :]
        total += gap * gap
    return np.sqrt(total)


def matrix(vectors) -> np.ndarray:
    return np.vstack(vectors.to_numpy())


def weighted_sums(asking: np.ndarray, points: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The summed distance of each asking row to all points, by tiles that stay in a core's cache."""
    total = np.zeros(len(asking))
    for j in range(0, len(points), TILE_ROWS):
        there, shares = np.ascontiguousarray(points[j : j + TILE_ROWS].T), weights[j : j + TILE_ROWS]
        for i in range(0, len(asking), ASKING_TILE):
            own = asking[i : i + ASKING_TILE]
            squares, gaps = np.zeros((2, len(own), there.shape[1]))
            for axis, values in enumerate(there):
                np.subtract.outer(own[:, axis], values, out=gaps)
                np.multiply(gaps, gaps, out=gaps)
                np.add(squares, gaps, out=squares)
            total[i : i + ASKING_TILE] += np.sqrt(squares, out=squares) @ shares
    return total


def condensed(points: np.ndarray, weights: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted nodes that stand for weighted points of a box, or the points where these are no more."""
    wide = np.flatnonzero(high > low)
    if NODES ** len(wide) >= len(points):
        return points, weights
    nodes = np.full((NODES,) * len(wide) + (len(low),), low)
    for place, axis in enumerate(wide):
        at = (low[axis] + high[axis]) / 2 + (high[axis] - low[axis]) / 2 * np.cos(_ANGLES)
        nodes[..., axis] = at.reshape([-1 if i == place else 1 for i in range(len(wide))])
    total = np.zeros(NODES ** len(wide))
    for start in range(0, len(points), TILE_ROWS):
        part = points[start : start + TILE_ROWS]
        shares = weights[start : start + TILE_ROWS][:, None]
        for axis in wide:
            unit = np.clip((2 * part[:, axis] - low[axis] - high[axis]) / (high[axis] - low[axis]), -1, 1)
            own = np.cos(np.outer(np.arccos(unit), np.arange(NODES))) @ _DUAL
            shares = (shares[:, :, None] * own[:, None, :]).reshape(len(part), -1)
        total += shares.sum(axis=0)
    return nodes.reshape(-1, len(low)), total


def _parents(tree) -> dict[int, int]:
    return {child: node for node, (_, _, left, right) in enumerate(tree[1]) for child in (left, right)}


def boxes_asked(tree, boxes: dict[int, tuple[np.ndarray, np.ndarray]], low: np.ndarray, high: np.ndarray):
    """(asking, node, far): for each asking box the largest far boxes, and the near leaves; together they hold every row once."""
    found, stack = [], [(tree[0], np.arange(len(low)))]
    while stack:
        node, at = stack.pop()
        if not len(at) or node not in boxes:
            continue
        own_low, own_high = boxes[node]
        gaps = np.maximum(np.maximum(low[at] - own_high, own_low - high[at]), 0)
        far = (gaps**2).sum(axis=1) >= (APART * (own_high - own_low).max() / 2) ** 2
        found.append((at[far], node, True))
        if node < 0:
            found.append((at[~far], node, False))
        else:
            _, _, left, right = tree[1][node]
            stack += [(left, at[~far]), (right, at[~far])]
    return found


_BOX = "low array<double>, high array<double>"
_SOURCES = "flat array<double>, weights array<double>"


class ClusterSums:
    """The rows (v, x, weight, cluster) of clusters, placed, with the boxes of each cluster."""

    def __init__(self, vectors: DataFrame, count: int, leaf_rows: int = LEAF_ROWS):
        # One tree: beyond the square of some thousands of leaves these hold more rows.
        self.space = space = SpacePartition(vectors, count, max(leaf_rows, -(-count // TREE_LEAVES)))
        placed = space.home(vectors.select("v", "x", "weight", F.col("cluster").alias("other")))

        def packed(group):
            points, weights = matrix(group.x), group.weight.to_numpy().astype(float)
            low, high = points.min(axis=0), points.max(axis=0)
            nodes, totals = condensed(points, weights, low, high)
            own = {"other": group.other.iloc[0], "node": -group.leaf.iloc[0], "low": low, "high": high}
            return pd.DataFrame([{**own, "flat": points.ravel(), "weights": weights, "nodes": nodes.ravel(), "totals": totals}])

        columns = f"other bigint, node bigint, {_BOX}, {_SOURCES}"
        leaves = placed.groupBy("other", "leaf").applyInPandas(packed, f"{columns}, nodes array<double>, totals array<double>")
        leaves = materialise(leaves, "leaves")
        top = space.top

        def above(batches):
            parents = _parents(top.value)
            for batch in batches:
                lists = []
                for node in batch.node:
                    lists.append([])
                    while (node := parents.get(node)) is not None:
                        lists[-1].append(node)
                yield batch.assign(above=lists)

        def merged(group):
            low, high = matrix(group.low).min(axis=0), matrix(group.high).max(axis=0)
            points, weights = np.concatenate(group.flat.to_list()).reshape(-1, len(low)), np.concatenate(group.weights.to_list())
            nodes, totals = condensed(points, weights, low, high)
            own = {"other": group.other.iloc[0], "node": group.node.iloc[0], "low": low, "high": high}
            return pd.DataFrame([{**own, "flat": nodes.ravel(), "weights": totals}])

        afar = leaves.select("other", "node", "low", "high", F.col("nodes").alias("flat"), F.col("totals").alias("weights"))
        inner = afar.mapInPandas(above, f"{columns}, above array<bigint>").withColumn("node", F.explode("above")).drop("above")
        inner = inner.groupBy("other", "node").applyInPandas(merged, columns)
        near = leaves.select("other", "node", "low", "high", "flat", "weights", F.lit(False).alias("far"))
        self.sources = materialise(near.unionAll(afar.unionAll(inner).withColumn("far", F.lit(True))), "sources")

    def of(self, visits: DataFrame) -> DataFrame:
        """(v, other, total): summed distance of each visiting vector (v, x, other) to all rows of cluster ``other``."""
        visits = materialise(self.space.home(visits.select("v", "x", "other")), "placed")
        sides = F.posexplode("x").alias("axis", "value")
        ends = visits.select("leaf", "other", sides).groupBy("leaf", "other", "axis").agg(F.min("value").alias("low"), F.max("value").alias("high"))
        ends = ends.groupBy("leaf", "other").agg(F.array_sort(F.collect_list(F.struct("axis", "low", "high"))).alias("ends"))
        shares = ends.groupBy("other").agg(F.ceil(F.count("*") / ASKING_LEAVES).alias("shares"))
        asking = ends.join(shares, "other").select("leaf", "other", F.col("ends.low").alias("low"), F.col("ends.high").alias("high"), F.pmod(F.xxhash64("leaf"), F.col("shares")).alias("share"))
        boxes = self.sources.filter("far").select("other", "node", "low", "high").join(shares, "other")
        boxes = boxes.select("other", "node", "low", "high", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share"))
        top = self.space.top

        def asked(there, box):
            if not len(there) or not len(box):
                return pd.DataFrame({"leaf": [], "other": [], "node": [], "far": []})
            known = dict(zip(box.node, zip(box.low, box.high)))
            found = boxes_asked(top.value, known, matrix(there.low), matrix(there.high))
            leaf, other = there.leaf.to_numpy(), there.other.iloc[0]
            return pd.concat([pd.DataFrame({"leaf": leaf[at], "other": other, "node": node, "far": far}) for at, node, far in found])

        keys = ["other", "share"]
        wanted = asking.groupBy(keys).cogroup(boxes.groupBy(keys)).applyInPandas(asked, "leaf bigint, other bigint, node bigint, far boolean")
        met = materialise(wanted, "wanted").join(self.sources.select("other", "node", "far", "flat", "weights"), ["other", "node", "far"])

        def summed(rows, there):
            if not rows.num_rows or not there.num_rows:
                return pa.table({"v": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "total": pa.array([], pa.float64())})
            own = arrow_matrix(rows["x"])
            flat, weights = (there[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("flat", "weights"))
            return pa.table({"v": rows["v"], "other": rows["other"], "total": weighted_sums(own, flat.reshape(-1, own.shape[1]), weights)})

        keys = ["leaf", "other"]
        return visits.groupBy(keys).cogroup(met.select("leaf", "other", "flat", "weights").groupBy(keys)).applyInArrow(summed, "v bigint, other bigint, total double")
