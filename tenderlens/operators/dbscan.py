"""Exact density clustering on cells.

Space is cut into cells whose diagonal is just under eps, so all rows of a cell are
neighbours. A cell with min_samples rows is all core and is never compared with
itself, whatever its size; a thinner cell holds fewer than min_samples rows, so the
comparisons of its rows with a full neighbouring cell grow with that cell, not with
its square. Whether two core cells touch is settled on bounding boxes, splitting the
boxes in two until a pair is certain or few rows are left. What remains is a graph
of cells, labelled by hooking and pointer jumping.

On more than three axes a cell has hundreds of others within eps, and pairs of cells are
many more than rows. There distinct vectors meet in the leaves of a kd partition instead:
they ask their own leaf first and others only while the answer is open, and what leaves a
task is a count, or a pair of components, never a pair of rows. Full cells still are core
and one component from the start, and those that fill leaves of their own are joined by
their boxes.
"""

import math
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderlens.functions import scalars as S
from tenderlens.operators import balls
from tenderlens.operators.neighbours import ASKING_ROWS, FIRST_ASKED, NO_LABEL, SpacePartition, arrow_matrix
from tenderlens.session import materialise, spread

# Axes up to which few cells lie within eps of one: 21 on two axes, some hundred on three.
CELL_AXES = 3
# Distinct vectors of a leaf in which they meet.
LEAF_VECTORS = 2048
# Shares of eps that vectors ask beyond their leaf, in turn: the first joins most of what belongs together.
ASKED_SHARES = (0.25, 1.0)

# Row pairs that may be compared directly instead of splitting boxes further.
DIRECT_PAIRS = 20_000_000
# Cells of a leaf in which they meet.
LEAF_CELLS = 128
# Tables of pairs are far larger in memory than on disk, where their repeated arrays shrink: no join sends them through the
# driver, whatever the size of their files.
NO_BROADCAST = "merge"
# Clusters that may be numbered by one window task.
WINDOW_ROWS = 1_000_000


def _parts(name: str, dims: int) -> list[Column]:
    return [F.col(name)[i] for i in range(dims)]


def _box(dims: int) -> list[Column]:
    low = F.array(*[F.min(v) for v in _parts("x", dims)]).alias("lo")
    high = F.array(*[F.max(v) for v in _parts("x", dims)]).alias("hi")
    return [low, high]


def _root_of_squares(sides: list[Column]) -> Column:
    return S.distance(sides, [F.lit(0.0)] * len(sides))


def _gap(a: tuple[str, str], b: tuple[str, str], dims: int) -> Column:
    """The least distance between two boxes; a row is the box (x, x)."""
    (alo, ahi), (blo, bhi) = [[_parts(n, dims) for n in box] for box in (a, b)]
    return _root_of_squares(
        [F.greatest(alo[i] - bhi[i], blo[i] - ahi[i], F.lit(0.0)) for i in range(dims)]
    )


def _reach(a: tuple[str, str], b: tuple[str, str], dims: int) -> Column:
    """The greatest distance between two boxes."""
    (alo, ahi), (blo, bhi) = [[_parts(n, dims) for n in box] for box in (a, b)]
    return _root_of_squares([F.greatest(ahi[i] - blo[i], bhi[i] - alo[i]) for i in range(dims)])


def _renamed(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}_{suffix}") for c in df.columns])


def near_cells(cells: DataFrame, eps: float, dims: int, leaf_rows: int = LEAF_CELLS, tree_leaves: int | None = None) -> DataFrame:
    """All ordered pairs (a, b) of cells, itself included, with boxes at most eps apart.

    Cells meet in the leaves of a kd partition of their centres, which splits axes of any
    number of values. A cell's box reaches eps / 2 from its centre, so cells within eps have
    centres within 2 eps: one of the two waits in its own leaf, the other goes to all leaves so near.
    """
    centre = F.transform(F.arrays_zip("lo", "hi"), lambda e: (e["lo"] + e["hi"]) / 2)
    points = spread(materialise(cells.withColumn("x", centre), "centres"))
    space = SpacePartition(points, points.count(), leaf_rows, tree_leaves)
    # Radii with a little to spare for rounding.
    left = space.touched(points.withColumn("radius", F.lit(2 * eps * (1 + 1e-6))), "radius").drop("x", "radius", "gap")
    right = space.home(points).drop("x").hint(NO_BROADCAST)
    pairs = _renamed(left, "a").withColumnRenamed("leaf_a", "leaf").join(_renamed(right, "b").withColumnRenamed("leaf_b", "leaf"), "leaf")
    pairs = pairs.filter(_gap(("lo_a", "hi_a"), ("lo_b", "hi_b"), dims) <= eps)
    return pairs.select("cell_a", "cell_b", "n_a", "n_b", "lo_b", "hi_b")


def _row_distance(dims: int) -> Column:
    return S.distance(_parts("x", dims), _parts("other", dims))


def _core_flags(rows: DataFrame, pairs: DataFrame, eps: float, min_samples: int, dims: int) -> DataFrame:
    """(id, x, cell, core): a row is core with min_samples rows, itself included, within eps."""
    dense = rows.filter(F.col("n") >= min_samples)
    thin = rows.filter(F.col("n") < min_samples).select("id", "x", "cell")
    met = thin.join(pairs, thin.cell == pairs.cell_a).select("id", "x", "cell_b", "n_b", "lo_b", "hi_b")
    box = ("lo_b", "hi_b")
    met = met.filter(_gap(("x", "x"), box, dims) <= eps).withColumn("whole", _reach(("x", "x"), box, dims) <= eps)
    whole = met.groupBy("id").agg(F.sum(F.when(F.col("whole"), F.col("n_b")).otherwise(0)).alias("known"))
    # Only rows still short of min_samples look into partly covered cells.
    short = met.filter(~F.col("whole")).join(whole.filter(F.col("known") < min_samples).select("id"), "id", "left_semi")
    others = rows.select(F.col("cell").alias("cell_b"), F.col("x").alias("other"))
    partial = short.select("id", "x", "cell_b").join(others, "cell_b").filter(_row_distance(dims) <= eps)
    counted = whole.unionAll(partial.groupBy("id").agg(F.count("*").alias("known")))
    core_ids = counted.groupBy("id").agg(F.sum("known").alias("known")).filter(F.col("known") >= min_samples)
    flagged = thin.join(core_ids.select("id", F.lit(True).alias("core")), "id", "left")
    return dense.select("id", "x", "cell", F.lit(True).alias("core")).unionAll(
        flagged.select("id", "x", "cell", F.coalesce("core", F.lit(False)).alias("core"))
    )


def _links(core: DataFrame, core_cells: DataFrame, pairs: DataFrame, eps: float, side: float, dims: int, direct: int):
    """(u, v): core cells, named by their lowest core row, that hold two rows at most eps apart."""
    a = _renamed(core_cells.select("cell", "root", "core_n", "lo", "hi"), "a")
    b = _renamed(core_cells.select("cell", "root", "core_n", "lo", "hi"), "b")
    met = pairs.select("cell_a", "cell_b").join(a, "cell_a").join(b, "cell_b").filter("root_a < root_b")
    boxes = ("lo_a", "hi_a"), ("lo_b", "hi_b")
    met = met.filter(_gap(*boxes, dims) <= eps).withColumn("sure", _reach(*boxes, dims) <= eps)
    met = materialise(
        met.select("root_a", "root_b", "cell_a", "cell_b", "sure", (F.col("core_n_a") * F.col("core_n_b")).alias("work")),
        "met",
    ).hint(NO_BROADCAST)
    linked = [met.filter("sure").select("root_a", "root_b")]
    open_ = met.filter("not sure").drop("sure")
    level = 0
    while True:
        work = open_.agg(F.sum(F.col("work").cast("double"))).first()[0]
        if work is None:
            break
        grid = side / 2**level
        inside = core.select("x", F.array(*[F.floor(v / grid) for v in _parts("x", dims)]).alias("cell"))
        if work <= direct:
            near = open_.join(inside.withColumnRenamed("cell", "cell_a"), "cell_a")
            near = near.join(inside.select(F.col("cell").alias("cell_b"), F.col("x").alias("other")), "cell_b")
            linked.append(near.filter(_row_distance(dims) <= eps).select("root_a", "root_b").distinct())
            break
        level += 1
        touched = open_.select(F.col("cell_a").alias("cell")).unionAll(open_.select("cell_b")).distinct()
        finer = F.array(*[F.floor(v / (side / 2**level)) for v in _parts("x", dims)])
        halves = inside.join(touched, "cell", "left_semi").groupBy(F.col("cell").alias("parent"), finer.alias("cell"))
        halves = materialise(halves.agg(F.count("*").alias("core_n"), *_box(dims)), "halves")
        split = open_.select("root_a", "root_b", F.col("cell_a").alias("parent_a"), F.col("cell_b").alias("parent_b"))
        split = split.join(_renamed(halves, "a"), "parent_a").join(_renamed(halves, "b"), "parent_b")
        split = split.filter(_gap(*boxes, dims) <= eps).withColumn("sure", _reach(*boxes, dims) <= eps)
        split = materialise(
            split.select("root_a", "root_b", "cell_a", "cell_b", "sure", (F.col("core_n_a") * F.col("core_n_b")).alias("work")),
            "split",
        ).hint(NO_BROADCAST)
        settled = split.filter("sure").select("root_a", "root_b").distinct()
        linked.append(settled)
        open_ = split.filter("not sure").drop("sure").join(settled, ["root_a", "root_b"], "left_anti")
    edges = linked[0]
    for more in linked[1:]:
        edges = edges.unionAll(more)
    return edges.toDF("u", "v")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): the lowest node of each connected component.

    Each round offers every node, and its present root, the lowest root next to it, then
    jumps to the root of the root; the number of rounds grows with the logarithm of the
    longest path.
    """
    both = materialise(edges.select("u", "v").unionAll(edges.select("v", "u")).distinct(), "edges")
    labels = nodes.select("node", F.col("node").alias("root"))
    while True:
        there = labels.select(F.col("node").alias("v"), F.col("root").alias("seen"))
        low = both.join(there, "v").groupBy(F.col("u").alias("node")).agg(F.min("seen").alias("low"))
        step = labels.join(low, "node", "left")
        better = step.filter("low < root")
        offers = step.select("node", "root", F.least("root", "low").alias("next")).unionAll(
            better.select(F.col("root").alias("node"), F.lit(None).alias("root"), F.col("low").alias("next"))
        )
        offers = offers.groupBy("node").agg(F.max("root").alias("root"), F.min("next").alias("next"))
        jump = offers.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = offers.join(jump, "next").select("node", "root", F.least("next", "far").alias("next"))
        moved = materialise(moved, "labels")
        labels = moved.select("node", F.col("next").alias("root"))
        if moved.filter("next <> root").isEmpty():
            return labels


def numbered(df: DataFrame, column: str, name: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Distinct values of a column with their place in ascending order, from 0.

    Many values are range-partitioned, numbered within their part and shifted by the
    sizes of the parts before it.
    """
    values = materialise(df.select(column).distinct(), "values")
    if values.count() <= window_rows:
        return values.selectExpr(column, f"cast(row_number() over (order by {column}) - 1 as bigint) as {name}")
    parts = values.repartitionByRange(column).withColumn("_part", F.spark_partition_id())
    parts = materialise(parts, "parts")
    # One row per range partition.
    sizes = parts.groupBy("_part").agg(F.count("*").alias("rows"))
    starts = sizes.selectExpr("_part", "sum(rows) over (order by _part) - rows as start")
    return parts.join(F.broadcast(starts), "_part").selectExpr(
        column, f"start + row_number() over (partition by _part order by {column}) - 1 as {name}"
    )


class _Cells:
    """Rows with their cells, the cells, and the pairs of cells within eps."""

    def __init__(self, df: DataFrame, key: str, eps: float):
        if eps <= 0:
            raise ValueError("eps must be positive")
        first = df.select(F.size("features")).first()
        self.dims, self.eps = first[0] if first else 1, eps
        self.side = eps / math.sqrt(self.dims) * (1 - 1e-9)
        rows = df.select(F.col(f"`{key}`").alias("id"), F.col("features").alias("x"))
        rows = materialise(rows.withColumn("cell", self.cell_of()), "rows")
        cells = rows.groupBy("cell").agg(F.count("*").alias("n"), *_box(self.dims))
        self.cells = materialise(cells.withColumn("no", F.monotonically_increasing_id()), "cells")
        self.rows = rows.join(self.cells.select("cell", "n", "no"), "cell")

    def cell_of(self) -> Column:
        return F.array(*[F.floor(v / self.side) for v in _parts("x", self.dims)])

    def paired(self, cells: DataFrame) -> DataFrame:
        return materialise(near_cells(cells.select("cell", "n", "lo", "hi"), self.eps, self.dims), "pairs").hint(NO_BROADCAST)

    @cached_property
    def pairs(self) -> DataFrame:
        return self.paired(self.cells)


def _asked(there: DataFrame, sent: DataFrame, answer, schema: str) -> DataFrame:
    """What ``answer`` finds for the vectors ``sent`` to a leaf, among those ``there``; a leaf that many ask is there several times."""
    shares = sent.groupBy("leaf").agg(F.ceil(F.count("*") / ASKING_ROWS).cast("int").alias("shares"))
    there = there.join(shares, "leaf").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    sent = sent.join(shares, "leaf").withColumn("share", F.pmod(F.xxhash64("vid"), F.col("shares")).cast("int")).drop("shares")

    kinds = [column.split() for column in schema.split(", ")]
    nothing = pa.table({name: pa.array([], pa.int64()) for name, _ in kinds})
    # Leaves without any of one side have nothing to answer.
    there = there.groupBy("leaf", "share").cogroup(sent.groupBy("leaf", "share"))
    return there.applyInArrow(lambda points, asking: answer(points, asking) if len(points) and len(asking) else nothing, schema)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


class _Vectors:
    """Distinct vectors in the leaves of a kd partition, and the rows they stand for, with whether these are core."""

    def __init__(self, cut: _Cells, min_samples: int, leaf_rows: int, tree_leaves: int | None):
        self.cut, self.eps = cut, cut.eps
        rows = cut.rows.withColumn("x", F.array(*_parts("x", cut.dims)))
        vectors = rows.groupBy("x", "n", "no").agg(F.count("*").alias("weight"))
        # Rows of a full cell are core, and one group.
        group = F.when(F.col("n") >= min_samples, F.col("no")).otherwise(NO_LABEL).alias("grp")
        vectors = materialise(vectors.select(F.monotonically_increasing_id().alias("vid"), "x", "weight", group), "vectors")
        self.space = SpacePartition(vectors, max(vectors.count(), 1), leaf_rows, tree_leaves)
        self.placed = materialise(self.space.home(spread(vectors)), "leaves")
        known = self._counts(min_samples)
        met = rows.select("id", "x").join(vectors.select("vid", "x", "grp").join(known, "vid"), "x").drop("x")
        met = materialise(met, "met")
        thin = met.filter(F.col("grp") == NO_LABEL)
        core_ids = thin.groupBy("id").agg(F.sum("known").alias("known")).filter(F.col("known") >= min_samples)
        flags = thin.join(core_ids.select("id", F.lit(True).alias("core")), "id", "left").select("id", "vid", F.coalesce("core", F.lit(False)).alias("core"))
        self.flags = materialise(met.filter(F.col("grp") != NO_LABEL).select("id", "vid", F.lit(True).alias("core")).unionAll(flags), "flags")

    def _touched(self, points: DataFrame, radius: float, settled: tuple[str, DataFrame] | None = None) -> DataFrame:
        # Radii with a little to spare for rounding.
        return self.space.touched(spread(points).withColumn("radius", F.lit(radius * (1 + 1e-6))), "radius", settled).drop("radius")

    def _counts(self, min_samples: int) -> DataFrame:
        """(vid, known): the rows within eps of a vector; exact below min_samples, else at least that."""
        eps = self.eps

        def at_home(table):
            weights, asking = _numbers(table, "weight"), _numbers(table, "grp") == NO_LABEL
            known = balls.own_counts(arrow_matrix(table["x"]), weights, asking, eps, min_samples)
            return table.drop_columns(["weight", "grp"]).append_column("known", pa.array(known))

        def abroad(points, asking):
            known = _numbers(asking, "known")
            total = balls.counts(arrow_matrix(points["x"]), _numbers(points, "weight"), arrow_matrix(asking["x"]), eps, min_samples, known)
            return pa.table({"vid": asking["vid"], "known": total - known})

        home = self.placed.groupBy("leaf").applyInArrow(at_home, "vid bigint, x array<double>, leaf bigint, known bigint")
        home = materialise(home, "home")
        short = home.filter(F.col("known") < min_samples).withColumnRenamed("leaf", "own").drop("known")
        nearest = F.row_number().over(Window.partitionBy("vid").orderBy("gap", "leaf")).alias("place")
        far = materialise(self._touched(short, eps).filter("leaf <> own").select("vid", "x", "leaf", nearest), "far")
        known = home.select("vid", "known")
        for asks in (F.col("place") <= FIRST_ASKED, F.col("place") > FIRST_ASKED):
            sent = far.filter(asks).drop("place").join(known.filter(F.col("known") < min_samples), "vid")
            if sent.isEmpty():
                break
            answers = _asked(self.placed, sent, abroad, "vid bigint, known bigint")
            known = materialise(known.unionAll(answers).groupBy("vid").agg(F.sum("known").alias("known")), "known")
        return known

    def _crowded(self, core: DataFrame, leaf_rows: int, direct: int) -> DataFrame:
        """Links (u, v) of full cells that hold more vectors than a leaf, found on their boxes."""
        cells = core.filter(F.col("grp") != NO_LABEL).groupBy(self.cut.cell_of().alias("cell"))
        cells = cells.agg(F.min("label").alias("root"), F.count("*").alias("core_n"), *_box(self.cut.dims)).filter(F.col("core_n") > leaf_rows)
        cells = materialise(cells, "crowded")
        if cells.isEmpty():
            return cells.selectExpr("root as u", "root as v")
        pairs = self.cut.paired(cells.withColumnRenamed("core_n", "n"))
        return _links(core, cells, pairs, self.eps, self.cut.side, self.cut.dims, direct)

    def labelled(self, leaf_rows: int, direct: int) -> DataFrame:
        """(vid, x, leaf, label): core vectors with the label of their cluster, the number of one of its vectors."""
        eps = self.eps

        def at_home(table):
            root = balls.joined(arrow_matrix(table["x"]), _numbers(table, "grp"), eps)
            return table.append_column("label", pa.array(_numbers(table, "vid")[root]))

        def abroad(points, asking):
            found = balls.linked(arrow_matrix(points["x"]), _numbers(points, "label"), arrow_matrix(asking["x"]), _numbers(asking, "label"), eps)
            return pa.table(dict(zip("uv", found)))

        core = self.placed.drop("weight").join(self.flags.filter("core").select("vid").distinct(), "vid").select("vid", "x", "grp", "leaf")
        core = core.groupBy("leaf").applyInArrow(at_home, "vid bigint, x array<double>, grp bigint, leaf bigint, label bigint")
        core = materialise(core, "local")
        grouped = core.filter(F.col("grp") != NO_LABEL).select("grp", "label").distinct()
        one = grouped.join(grouped.groupBy("grp").agg(F.min("label").alias("low")), "grp").filter("label <> low")
        core = _relabelled(core, one.select(F.col("label").alias("u"), F.col("low").alias("v")).unionAll(self._crowded(core, leaf_rows, direct)))
        for share in ASKED_SHARES:
            # Of two leaves the one with the higher number asks.
            asking = core.select("vid", "x", "label", F.col("leaf").alias("own"))
            sent = self._touched(asking, share * eps, ("label", core.select("leaf", "label"))).filter("leaf < own")
            sent = materialise(sent.select("vid", "x", "label", "leaf"), "sent")
            core = _relabelled(core, _asked(core, sent, abroad, "u bigint, v bigint"))
        return core.select("vid", "x", "leaf", "label")

    def clusters(self, leaf_rows: int, direct: int) -> DataFrame:
        """(id, cluster) of all rows."""
        eps = self.eps

        def lowest(points, asking):
            found = balls.lowest(arrow_matrix(points["x"]), _numbers(points, "cluster"), arrow_matrix(asking["x"]), eps)
            near = found < np.iinfo(np.int64).max
            return pa.table({"vid": _numbers(asking, "vid")[near], "cluster": found[near]})

        core = self.labelled(leaf_rows, direct)
        firsts = self.flags.filter("core").groupBy("vid").agg(F.min("id").alias("first")).join(core.select("vid", "label"), "vid")
        firsts = firsts.groupBy("label").agg(F.min("first").alias("first"))
        places = firsts.select(F.struct(F.col("first").isNull().alias("none"), "first", "label").alias("place"))
        numbers = numbered(places, "place", "cluster").select("place.label", "cluster")
        core = materialise(core.join(numbers, "label").select("vid", "x", "leaf", F.col("cluster").cast("bigint").alias("cluster")), "clusters")

        rows = self.flags.filter("not core").select("id", "vid")
        loose = self.placed.join(rows.select("vid").distinct(), "vid").select("vid", "x", F.lit(NO_LABEL).cast("bigint").alias("label"))
        sent = self._touched(loose, eps, ("label", core.select("leaf", F.col("cluster").alias("label"))))
        sent = materialise(sent.select("vid", "x", "leaf"), "sent")
        border = _asked(core, sent, lowest, "vid bigint, cluster bigint").groupBy("vid").agg(F.min("cluster").alias("cluster"))
        found = self.flags.filter("core").select("id", "vid").join(core.select("vid", "cluster"), "vid").select("id", "cluster")
        return found.unionAll(rows.join(border, "vid", "left").select("id", F.coalesce("cluster", F.lit(-1)).alias("cluster")))


def _relabelled(core: DataFrame, links: DataFrame) -> DataFrame:
    """``core`` with one label for all that links (u, v) between labels connect."""
    links = materialise(links.distinct(), "links")
    if links.isEmpty():
        return core
    nodes = links.select(F.col("u").alias("node")).unionAll(links.select("v")).distinct()
    moved = components(nodes, links).filter("node <> root").withColumnRenamed("node", "label")
    return materialise(core.join(moved, "label", "left").withColumn("label", F.coalesce("root", "label")).drop("root"), "labelled")


def core_rows(df: DataFrame, key: str, eps: float, min_samples: int) -> DataFrame:
    """(key, core): whether at least min_samples rows, itself included, lie within eps."""
    cut = _Cells(df, key, eps)
    if cut.dims > CELL_AXES:
        flags = _Vectors(cut, min_samples, LEAF_VECTORS, None).flags
    else:
        flags = _core_flags(cut.rows, cut.pairs, eps, min_samples, cut.dims)
    return flags.select(F.col("id").alias(key), "core")


def dbscan(
    df: DataFrame, key: str, eps: float = 0.5, min_samples: int = 5, direct_pairs: int = DIRECT_PAIRS, leaf_rows: int = LEAF_VECTORS, tree_leaves: int | None = None
) -> DataFrame:
    """(key, cluster) for rows with ``features``; noise is -1.

    Clusters are numbered by their lowest core row, and a border row joins the lowest
    numbered cluster next to it. ``key`` must be unique. ``leaf_rows`` and ``tree_leaves``
    bound the partition of more than three axes.
    """
    cut = _Cells(df, key, eps)
    if cut.dims > CELL_AXES:
        found = _Vectors(cut, min_samples, leaf_rows, tree_leaves).clusters(leaf_rows, direct_pairs)
    else:
        found = _cell_clusters(cut, min_samples, direct_pairs)
    return found.select(F.col("id").alias(key), F.col("cluster").cast("bigint").alias("cluster"))


def _cell_clusters(cut: _Cells, min_samples: int, direct_pairs: int) -> DataFrame:
    """(id, cluster) of all rows, by pairs of cells."""
    eps, pairs, side, dims = cut.eps, cut.pairs, cut.side, cut.dims
    flags = materialise(_core_flags(cut.rows, pairs, eps, min_samples, dims), "flags")

    core = flags.filter("core").select("id", "x", "cell")
    core_cells = core.groupBy("cell").agg(F.min("id").alias("root"), F.count("*").alias("core_n"), *_box(dims))
    core_cells = materialise(core_cells, "core_cells")
    edges = _links(core, core_cells, pairs, eps, side, dims, direct_pairs)
    labels = components(core_cells.select(F.col("root").alias("node")), edges)
    numbers = numbered(labels, "root", "cluster")
    named = labels.join(numbers, "root").select(F.col("node").alias("root"), "cluster")
    clusters = materialise(core_cells.join(named, "root").select("cell", "cluster", "lo", "hi"), "clusters")

    loose = flags.filter("not core")
    met = loose.join(pairs.select("cell_a", "cell_b"), loose.cell == F.col("cell_a")).select("id", "x", "cell_b")
    met = met.join(_renamed(clusters, "b").withColumnRenamed("cluster_b", "cluster"), "cell_b")
    box = ("lo_b", "hi_b")
    met = met.filter(_gap(("x", "x"), box, dims) <= eps).withColumn("whole", _reach(("x", "x"), box, dims) <= eps)
    there = core.select(F.col("cell").alias("cell_b"), F.col("x").alias("other"))
    touched = met.filter("not whole").join(there, "cell_b").filter(_row_distance(dims) <= eps)
    border = met.filter("whole").select("id", "cluster").unionAll(touched.select("id", "cluster"))
    border = border.groupBy("id").agg(F.min("cluster").alias("cluster"))
    return core.join(clusters.select("cell", "cluster"), "cell").select("id", "cluster").unionAll(
        loose.select("id").join(border, "id", "left").select("id", F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    )


def flag_noise(df: DataFrame) -> DataFrame:
    return df.withColumn("is_outlier", F.col("cluster") == -1)


def noise_override(df: DataFrame) -> DataFrame:
    """Noise rows get the highest score."""
    return df.withColumn("anomaly_score", F.when(F.col("cluster") == -1, F.lit(1.0)).otherwise(F.col("anomaly_score")))


def cluster_counts(df: DataFrame) -> DataFrame:
    """Clusters without noise, noise rows and their percent."""
    counts = df.agg(
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"),
        F.count_if(F.col("cluster") == -1).alias("n_outliers"),
        F.count("*").alias("total_records"),
    )
    return counts.withColumn("outlier_percentage", S.percent(F.col("n_outliers"), F.col("total_records")))
