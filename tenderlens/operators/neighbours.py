"""Exact nearest neighbours over a space partition, and the scores built on them.

Equal vectors are merged first and carry a weight, so copies never meet each other.
A kd partition built from a bounded sample cuts space into leaves of a few thousand
distinct vectors. Where they are too many for one tree, each leaf of a first one is cut by a tree of its own, grown
on executors and kept as a table; the driver holds the first one only. Every vector finds its k nearest in its own leaf; only vectors
whose k-th distance reaches over a leaf border are sent on, to just those leaves: first
to the closest few, then, with the k-th distance these have left, to more.
Spark partitions, shuffles and merges; NumPy searches within one leaf.
"""

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tenderlens.functions.quantiles import portable_hash, sample_rows
from tenderlens.session import materialise

LEAF_ROWS = 2048
# Leaves of one tree; two levels hold the square of it.
TREE_LEAVES = 32_768
_SAMPLES_PER_LEAF = 8
# Numbers that the leaves of one tree of the second level may take.
TREE_NUMBERS = 1 << 31
# Further leaves a vector asks in its first round; each round asks four times as many.
FIRST_ASKED = 4
# Vectors that ask one leaf in one group.
ASKING_ROWS = 16_384
# Pairs of a vector and a leaf that one task holds at a time: a ball on many axes touches hundreds of leaves.
PART_PAIRS = 32_768
# Leaves whose rows have several labels, or none.
MIXED, NO_LABEL = -2, -1


def cut_space(sample: np.ndarray, leaves: int):
    """A kd partition (root, nodes): inner nodes (axis, split, left, right), leaves as negative numbers."""
    nodes, count = [], 0

    def grow(points, share):
        nonlocal count
        spread = np.ptp(points, axis=0) if len(points) > 1 else np.zeros(1)
        if share <= 1 or spread.max() == 0:
            count += 1
            return -count
        axis = int(spread.argmax())
        split = float(np.median(points[:, axis]))
        lower = points[:, axis] <= split
        if lower.all():
            split = float(points[points[:, axis] < split, axis].max())
            lower = points[:, axis] <= split
        index = len(nodes)
        nodes.append(None)
        # Leaves are shared out by rows, so that a crowded side gets more of them.
        left = min(max(round(share * float(lower.mean())), 1), share - 1)
        nodes[index] = (axis, split, grow(points[lower], left), grow(points[~lower], share - left))
        return index

    return grow(sample, leaves), nodes


def reached_parts(tree, points: np.ndarray, radii: np.ndarray | None = None, settled: tuple[np.ndarray, dict] | None = None):
    """Pairs (row, leaf, gap) of every leaf the ball around a row touches, in parts of some ``PART_PAIRS``; without radii the home leaf.

    The gap is the distance of the row to the leaf's region. With ``settled``, a label of each row and those of leaves, a row
    passes by leaves of its own label and by leaves that have none.
    """
    root, nodes = tree
    names = _labels(tree, settled[1]) if settled else None
    rows, leaves, away, held = [], [], [], 0
    # The squared distance of a row to a region is the sum of its squared offsets per axis.
    limits = None if radii is None else radii**2 * (1 + 1e-9)
    stack = [(root, np.arange(len(points)), np.zeros(points.shape))]
    while stack:
        node, at, offsets = stack.pop()
        if names is not None and names[node] != MIXED:
            open_ = settled[0][at] != names[node] if names[node] != NO_LABEL else np.zeros(len(at), bool)
            at, offsets = at[open_], offsets[open_]
        if not len(at):
            continue
        if node < 0:
            rows.append(at)
            leaves.append(np.full(len(at), -node))
            away.append(np.sqrt((offsets**2).sum(axis=1)))
            held += len(at)
            if held >= PART_PAIRS:
                yield np.concatenate(rows), np.concatenate(leaves), np.concatenate(away)
                rows, leaves, away, held = [], [], [], 0
            continue
        axis, split, left, right = nodes[node]
        offset = points[at, axis] - split
        near_left = offset <= 0
        for child, near in ((left, near_left), (right, ~near_left)):
            stack.append((child, at[near], offsets[near]))
            if limits is None:
                continue
            far = np.flatnonzero(~near)
            moved = offsets[far]
            moved[:, axis] = offset[far]
            close = (moved**2).sum(axis=1) <= limits[at[far]]
            stack.append((child, at[far[close]], moved[close]))
    if held:
        yield np.concatenate(rows), np.concatenate(leaves), np.concatenate(away)


def _labels(tree, leaf_labels: dict) -> dict:
    """The label of each node, leaves included: the one that all leaves below share, ``MIXED`` or ``NO_LABEL``."""
    root, nodes = tree
    names = {}
    named = lambda node: leaf_labels.get(-node, NO_LABEL) if node < 0 else names[node]
    # Nodes stand before those below them.
    for index in reversed(range(len(nodes))):
        left, right = nodes[index][2:]
        below = {named(left), named(right)} - {NO_LABEL}
        names[index] = MIXED if len(below) > 1 else below.pop() if below else NO_LABEL
        names |= {node: named(node) for node in (left, right) if node < 0}
    return names | {root: named(root)}


def reached(tree, points: np.ndarray, radii: np.ndarray | None = None, gaps: bool = False):
    """All parts of :func:`reached_parts` as one: (row, leaf) or, with ``gaps``, (row, leaf, gap)."""
    none = np.empty(0, int), np.empty(0, int), np.empty(0, float)
    found = [np.concatenate(v) for v in zip(none, *reached_parts(tree, points, radii))]
    return tuple(found) if gaps else tuple(found[:2])


def flat_tree(tree):
    """A partition as (root, axes, splits, children), for :func:`homes`."""
    root, nodes = tree
    axes, splits, left, right = zip(*nodes) if nodes else ((), (), (), ())
    return root, np.array(axes, int), np.array(splits, float), np.array([left, right], int)


def homes(flat, points: np.ndarray):
    """What :func:`reached` finds without radii, in the same order: all rows go down a level at once, whatever the number of leaves."""
    root, axes, splits, children = flat
    at = np.full(len(points), root)
    while len(rows := np.flatnonzero(at >= 0)):
        node = at[rows]
        at[rows] = children[np.where(points[rows, axes[node]] - splits[node] <= 0, 0, 1), node]
    rows = np.argsort(at, kind="stable")
    return rows, -at[rows]


def nearest(points: np.ndarray, queries: np.ndarray, k: int, bounds: np.ndarray | None = None, bucket: int = 256):
    """Distances and row numbers of the k nearest ``points`` of each query, inf and -1 where missing.

    Descends a median split of the points; a half is visited only by queries whose
    current k-th distance (or given bound) reaches across the split.
    """
    k = min(k, max(len(points), 1))
    best = np.full((len(queries), k), np.inf)
    found = np.full((len(queries), k), -1)
    limit = np.full(len(queries), np.inf) if bounds is None else bounds

    def scan(rows, at):
        for start in range(0, len(at), 4096):
            part = at[start : start + 4096]
            gaps = queries[part][:, None, :] - points[rows][None, :, :]
            dist = np.sqrt(_sum_in_order(gaps * gaps))
            both = np.concatenate([best[part], dist], axis=1)
            ids = np.concatenate([found[part], np.broadcast_to(rows, dist.shape)], axis=1)
            keep = np.argsort(both, axis=1, kind="stable")[:, :k]
            best[part] = np.take_along_axis(both, keep, axis=1)
            found[part] = np.take_along_axis(ids, keep, axis=1)

    def visit(rows, at):
        if not len(at) or not len(rows):
            return
        spread = np.ptp(points[rows], axis=0)
        if len(rows) <= bucket or spread.max() == 0:
            scan(rows, at)
            return
        axis = spread.argmax()
        values = points[rows, axis]
        order = np.argpartition(values, len(rows) // 2)
        split = values[order[len(rows) // 2]]
        lower = values < split
        if not lower.any():
            lower = values <= split
        halves = rows[lower], rows[~lower]
        position = queries[at, axis]
        edges = halves[0], halves[1]
        low_edge, high_edge = points[edges[0], axis].max(), points[edges[1], axis].min()
        goes_low = position < split
        visit(halves[0], at[goes_low])
        visit(halves[1], at[~goes_low])
        reach = np.minimum(best[at, -1], limit[at])
        visit(halves[1], at[goes_low & (high_edge - position <= reach)])
        reach = np.minimum(best[at, -1], limit[at])
        visit(halves[0], at[~goes_low & (position - low_edge <= reach)])

    visit(np.arange(len(points)), np.arange(len(queries)))
    return best, found


def _sum_in_order(squares):
    """Sum over the last axis from first to last, the order the SQL expressions use."""
    total = squares[..., 0].copy()
    for i in range(1, squares.shape[-1]):
        total += squares[..., i]
    return total


def _matrix(vectors) -> np.ndarray:
    return np.vstack(vectors.to_numpy()) if len(vectors) else np.empty((0, 1))


def arrow_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix, without an object per row."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pc.count_distinct(pc.list_value_length(lists), mode="all").as_py() > 1:
        raise ValueError("vectors of several lengths")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _drawn(share: float, seed: int) -> Column:
    """Whether a vector is in a sample of this share, by its hash."""
    text = F.array_join(F.transform("x", lambda v: v.cast("string")), ",")
    return portable_hash(text, seed) < int(min(1.0, share) * 2**52)


def _sorted(sample: np.ndarray) -> np.ndarray:
    return sample[np.lexsort(sample.T)]


class SpacePartition:
    """A kd partition of distinct vectors ``x`` into leaves of some ``leaf_rows``, of one level or two.

    Leaves are numbers. Rows find their own leaf with :meth:`home` and all leaves that a ball around them touches with
    :meth:`touched`.
    """

    def __init__(self, vectors: DataFrame, count: int, leaf_rows: int, tree_leaves: int | None = None):
        most = tree_leaves or TREE_LEAVES
        leaves = max(count // leaf_rows, 1)
        # Each side of two levels is filled evenly.
        top = leaves if leaves <= most else min(most, math.ceil(math.sqrt(leaves)))
        # A bounded sample: rows whose hash falls under a fixed share, about 8 per leaf.
        rows = vectors.filter(_drawn(top * _SAMPLES_PER_LEAF / count, 7)).select("x").collect() if top > 1 else []
        sample = np.array([row.x for row in rows]) if rows else np.zeros((1, 1))
        self.top = vectors.sparkSession.sparkContext.broadcast(cut_space(_sorted(sample), top))
        self.below = None if top == leaves else self._grown(vectors, count, -(-leaves // top))

    def _grown(self, vectors: DataFrame, count: int, leaves: int) -> DataFrame:
        """(top, tree): a tree for each leaf of the first one, from a sample of the rows there."""

        def grow(group):
            tree = cut_space(_sorted(_matrix(group.x)), leaves)
            return pd.DataFrame({"top": [group.top.iloc[0]], "tree": [pickle.dumps(tree)]})

        tops = self.top.value[0] if self.top.value[0] < 0 else 1 + sum(1 for _ in self.top.value[1])
        share = leaves * abs(tops) * _SAMPLES_PER_LEAF / count
        sample = self._at_top(vectors.select("x").filter(_drawn(share, 11)), None)
        return materialise(sample.groupBy("top").applyInPandas(grow, "top bigint, tree binary"), "trees")

    def _at_top(self, rows: DataFrame, radius: str | None, name: str = "top", settled: tuple[str, dict] | None = None) -> DataFrame:
        """``rows`` with the leaves of the first tree: their own or, with a column ``radius``, all that are touched, and their ``gap``."""
        top = self.top
        label, leaf_labels = settled or (None, None)
        known = rows.sparkSession.sparkContext.broadcast(leaf_labels) if settled else None

        def place(batches):
            flat = flat_tree(top.value)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = arrow_matrix(batch.column("x"))
                if radius is None:
                    parts = [homes(flat, x)]
                else:
                    passed = (batch.column(label).to_numpy(zero_copy_only=False), known.value) if known else None
                    parts = reached_parts(top.value, x, batch.column(radius).to_numpy(zero_copy_only=False), passed)
                for at, *found in parts:
                    names = batch.schema.names + [name, "gap"][: len(found)]
                    yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at)).columns, *map(pa.array, found)], names=names)

        fields = [T.StructField(name, T.LongType())] + ([] if radius is None else [T.StructField("gap", T.DoubleType())])
        return rows.mapInArrow(place, T.StructType([*rows.schema.fields, *fields]))

    def _below(self, rows: DataFrame, radius: str | None) -> DataFrame:
        """Rows at leaves ``top`` of the first tree with the leaves of the second one.

        Rows of a leaf are dealt over some tasks, and in each of them its tree comes first.
        """
        shares = rows.groupBy("top").agg(F.ceil(F.count("*") / ASKING_ROWS).alias("shares"))
        trees = self.below.join(shares, "top").select("top", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share"), "tree")
        known = rows.join(shares, "top").withColumn("share", F.pmod(F.xxhash64("x"), F.col("shares"))).drop("shares")
        both = known.withColumn("tree", F.lit(None).cast("binary")).unionByName(trees, allowMissingColumns=True)
        dealt = both.repartition("top", "share").sortWithinPartitions("top", "share", F.col("tree").isNull())
        columns = rows.columns

        def place(batches):
            tree = None
            for batch in batches:
                cuts = np.flatnonzero(batch.tree.notna().to_numpy())
                for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                    part = batch.iloc[a:b]
                    if len(part) and part.tree.iloc[0] is not None:
                        tree, part = pickle.loads(part.tree.iloc[0]), part.iloc[1:]
                    if not len(part):
                        continue
                    x, part = _matrix(part.x), part[columns]
                    for at, leaves, gaps in reached_parts(tree, x, None if radius is None else part[radius].to_numpy()):
                        found = part.iloc[at]
                        if radius is not None:
                            # The distance to the region of the leaf is at least that to each tree's part of it.
                            found = found.assign(gap=np.maximum(found.gap.to_numpy(), gaps))
                        yield found.assign(leaf=found.top.to_numpy() * TREE_NUMBERS + leaves)

        schema = T.StructType([*rows.schema.fields, T.StructField("leaf", T.LongType())])
        return dealt.mapInPandas(place, schema).drop("top")

    def home(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their own ``leaf``."""
        return self._at_top(rows, None, "leaf") if self.below is None else self._below(self._at_top(rows, None), None)

    def touched(self, rows: DataFrame, radius: str, settled: tuple[str, DataFrame] | None = None) -> DataFrame:
        """``rows`` once for each ``leaf`` within the distance in column ``radius``, and the ``gap`` to it.

        ``settled`` names a column of labels and gives a table (leaf, label) of whole numbers: leaves without any label, and those with
        none but the row's, may be left out. They are told apart by leaves of the first tree.
        """
        if settled:
            top = F.col("leaf") if self.below is None else (F.col("leaf") / TREE_NUMBERS).cast("bigint")
            ends = settled[1].groupBy(top.alias("top")).agg(F.min("label").alias("low"), F.max("label").alias("high"))
            settled = settled[0], {r.top: r.low if r.low == r.high else MIXED for r in ends.collect()}
        if self.below is None:
            return self._at_top(rows, radius, "leaf", settled)
        return self._below(self._at_top(rows, radius, settled=settled), radius)


def nearest_distances(
    df: DataFrame, key: str, k: int, leaf_rows: int = LEAF_ROWS, asked: list | None = None, tree_leaves: int | None = None
) -> DataFrame:
    """(key, distances): the k smallest distances of each row, itself included, ascending.

    Fewer than k rows in the table give fewer distances. ``asked`` gets the number of
    questions to further leaves, by round. ``tree_leaves`` bounds the leaves of one tree.
    """
    points = df.select(F.col(f"`{key}`").alias(key), F.col("features").alias("x"))
    vectors = materialise(points.groupBy("x").agg(F.count("*").alias("weight")), "vectors")
    count = vectors.count()
    space = SpacePartition(vectors, count, leaf_rows, tree_leaves)
    placed = materialise(space.home(vectors), "leaves")
    tree = space.top if space.below is None else None

    def home(group):
        x = _matrix(group.x)
        weights = group.weight.to_numpy()
        dist, at = nearest(x, x, k)
        if dist.shape[1] < k:
            reach = np.full(len(x), np.inf)
        else:
            reach = dist[:, -1]
        # k copies of one vector are its k nearest already.
        asking = weights < k
        kept = at >= 0
        found = {
            "x": group.x.to_numpy(),
            "reach": reach,
            "d": [row[ok] for row, ok in zip(dist, kept)],
            "w": [weights[row[ok]] for row, ok in zip(at, kept)],
        }
        if tree is None:
            return pd.DataFrame({**found, "leaf": group.leaf.to_numpy(), "asking": asking})
        rows, leaves, gaps = reached(tree.value, x, reach, gaps=True)
        others = (leaves != group.leaf.iloc[0]) & asking[rows]
        rows, leaves, gaps = rows[others], leaves[others], gaps[others]
        order = np.lexsort((leaves, gaps, rows))
        cuts = np.searchsorted(rows[order], np.arange(1, len(x)))
        return pd.DataFrame({**found, "targets": np.split(leaves[order], cuts), "gaps": np.split(gaps[order], cuts)})

    found_type = "x array<double>, d array<double>, w array<bigint>"
    near = F.arrays_zip("d", "w").alias("near")
    if tree is not None:
        local = placed.groupBy("leaf").applyInPandas(home, f"{found_type}, reach double, targets array<bigint>, gaps array<double>")
        found = materialise(local.select("x", near, "reach", "targets", "gaps"), "local")
    else:
        local = placed.groupBy("leaf").applyInPandas(home, f"{found_type}, reach double, leaf bigint, asking boolean")
        local = materialise(local.select("x", near, "reach", F.col("leaf").alias("own"), "asking"), "local")
        far = space.touched(local.filter("asking").select("x", "reach", "own"), "reach").filter("leaf <> own")
        far = far.groupBy("x").agg(F.array_sort(F.collect_list(F.struct("gap", "leaf"))).alias("far"))
        none = F.array().cast("array<struct<gap:double,leaf:bigint>>")
        found = local.join(far, "x", "left").withColumn("far", F.coalesce("far", none))
        found = materialise(found.select("x", "near", "reach", F.col("far.leaf").alias("targets"), F.col("far.gap").alias("gaps")), "asking")

    def abroad(points_there, asked):
        if not len(asked) or not len(points_there):
            return pd.DataFrame({"x": [], "d": [], "w": []}, dtype=object)
        weights = points_there.weight.to_numpy()
        dist, at = nearest(_matrix(points_there.x), _matrix(asked.x), k, asked.reach.to_numpy())
        kept = at >= 0
        return pd.DataFrame(
            {
                "x": asked.x.to_numpy(),
                "d": [row[ok] for row, ok in zip(dist, kept)],
                "w": [weights[row[ok]] for row, ok in zip(at, kept)],
            }
        )

    settled, few = [], FIRST_ASKED
    while True:
        settled.append(found.filter(F.size("targets") == 0).select("x", "near"))
        open_ = found.filter(F.size("targets") > 0)
        if open_.isEmpty():
            break
        sent = open_.select("x", "reach", F.explode(F.slice("targets", 1, few)).alias("leaf"))
        if asked is not None:
            asked.append(sent.count())
        # A leaf that many ask is there several times, each for some of those who ask.
        shares = sent.groupBy("leaf").agg(F.ceil(F.count("*") / ASKING_ROWS).cast("int").alias("shares"))
        there = placed.join(shares, "leaf").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        sent = sent.join(shares, "leaf").withColumn("share", F.pmod(F.xxhash64("x"), F.col("shares")).cast("int"))
        remote = there.drop("shares").groupBy("leaf", "share").cogroup(sent.drop("shares").groupBy("leaf", "share"))
        remote = remote.applyInPandas(lambda _, points_there, asking: abroad(points_there, asking), found_type)
        absent = [F.lit(None).cast(kind).alias(name) for name, kind in (("reach", "double"), ("targets", "array<bigint>"), ("gaps", "array<double>"))]
        both = open_.unionAll(remote.select("x", F.arrays_zip("d", "w").alias("near"), *absent))
        # At most k lists entries from each leaf asked in this round, and k are kept.
        merged = both.groupBy("x").agg(
            F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"),
            *[F.max(F.when(F.col("reach").isNotNull(), F.struct("reach", "targets", "gaps"))).alias("own")],
        )
        kth = F.get(_unfold(F.col("near"), k), F.lit(k - 1))
        merged = merged.select("x", "near", F.least("own.reach", kth).alias("reach"), "own.targets", "own.gaps")
        rest = F.greatest(F.size(F.filter("gaps", lambda g: g <= F.col("reach") * (1 + 1e-9))) - few, F.lit(0))
        merged = merged.select("x", "near", "reach", F.slice("targets", few + 1, rest).alias("targets"), F.slice("gaps", few + 1, rest).alias("gaps"))
        found, few = materialise(merged, "merged"), 4 * few
    nearby = settled[0]
    for more in settled[1:]:
        nearby = nearby.unionAll(more)
    return points.join(nearby, "x").select(key, _unfold(F.col("near"), k).alias("distances"))


def _unfold(near: Column, k: int) -> Column:
    """The k smallest distances of weighted neighbours in ascending order."""
    copies = F.transform(
        F.slice(near, 1, k), lambda n: F.array_repeat(n["d"], F.least(n["w"], F.lit(k)).cast("int"))
    )
    return F.slice(F.flatten(copies), 1, k)


def mean_distance(distances: Column) -> Column:
    return F.aggregate(distances, F.lit(0.0), lambda a, d: a + d) / F.size(distances)


def knn_scores(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """(key, mean_distance, anomaly_score): mean distance to the k nearest over the highest such mean."""
    means = nearest_distances(df, key, k).select(key, mean_distance(F.col("distances")).alias("mean_distance"))
    means = materialise(means, "means")
    top = F.broadcast(means.agg(F.max("mean_distance").alias("_top")))
    return means.crossJoin(top).select(
        key, "mean_distance", F.try_divide("mean_distance", "_top").alias("anomaly_score")
    )


def neighbour_ranks(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """(key, rank, distance) of the k nearest rows."""
    ranked = nearest_distances(df, key, k).select(key, F.posexplode("distances").alias("position", "distance"))
    return ranked.select(key, (F.col("position") + 1).alias("rank"), "distance")


def _kth_steps(df: DataFrame, key: str, k: int, sample_size: int | None, seed: int) -> DataFrame:
    """(distance, rows, first, step): distinct k-th distances, how many rows share each, the place of the first, the step to it.

    Distances are range-partitioned and ordered within their part; a part then adds the rows of
    the parts before it and takes the step from their last distance.
    """
    rows = df.select(F.col(f"`{key}`").alias(key), "features")
    if sample_size is not None:
        rows = sample_rows(rows, F.col(key), sample_size, seed)
    kth = nearest_distances(materialise(rows, "sample"), key, k).select(F.element_at("distances", -1).alias("distance"))
    counts = materialise(kth.groupBy("distance").agg(F.count("*").alias("rows")), "kth")
    parts = materialise(counts.repartitionByRange("distance").withColumn("part", F.spark_partition_id()), "parts")
    ends = parts.groupBy("part").agg(F.sum("rows").alias("all"), F.max("distance").alias("last"))
    # One row per range part.
    ends = ends.selectExpr("part", "sum(all) over (order by part) - all as before", "lag(last) over (order by part) as previous")
    return parts.join(ends, "part").selectExpr(
        "distance",
        "rows",
        "before + sum(rows) over (partition by part order by distance) - rows + 1 as first",
        "distance - coalesce(lag(distance) over (partition by part order by distance), previous) as step",
    )


def sorted_kth(df: DataFrame, key: str, k: int = 5, sample_size: int | None = None, seed: int = 42) -> DataFrame:
    """(position, distance, step): k-th distances in order, and the step from the one before.

    Of all rows, or of ``sample_size`` where that is given.
    """
    each = _kth_steps(df, key, k, sample_size, seed).select("*", F.posexplode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("nth", "_"))
    return each.selectExpr("first + nth as position", "distance", "if(nth = 0, step, 0.0D) as step")


def elbow_eps(df: DataFrame, key: str, k: int = 5, sample_size: int | None = None, seed: int = 42) -> DataFrame:
    """One row: the k-th distance after the largest step, the first such on a tie."""
    steps = _kth_steps(df, key, k, sample_size, seed).withColumnRenamed("first", "position")
    # A distance that several rows share is followed by a step of 0.
    again = steps.filter("rows > 1").selectExpr("position + 1 as position", "distance", "0.0D as step")
    steps = steps.select("position", "distance", "step").unionAll(again)
    return steps.filter("step is not null").orderBy(F.desc("step"), "position").limit(1).select(
        F.col("distance").alias("eps")
    )
