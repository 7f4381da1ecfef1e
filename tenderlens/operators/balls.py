"""Vectors within a distance of others, in the leaves of a space partition.

Each function compares asking vectors with those of one leaf, tile by tile, and keeps only what is asked for: a count up to a
bound, a component, a pair of labels, a lowest value. Pairs of vectors are never listed. Vectors of a leaf lie in boxes of
some ``BOX_ROWS``; a box is passed by where it is too far, or where it has nothing to add to what is known.
"""

import numpy as np

BOX_ROWS = 256
ASKING_TILE = 128
# Boxes are compared with a little to spare for rounding; distances of vectors are exact.
_SPARE = 1 + 1e-9


def boxes(points: np.ndarray, size: int = BOX_ROWS) -> list[np.ndarray]:
    """Row numbers of the points, halved along the widest axis until few are left."""
    found, stack = [], [np.arange(len(points))] if len(points) else []
    while stack:
        at = stack.pop()
        if len(at) <= size:
            found.append(at)
            continue
        order = at[np.argpartition(points[at, np.ptp(points[at], axis=0).argmax()], len(at) // 2)]
        stack += [order[: len(at) // 2], order[len(at) // 2 :]]
    return found


def _in_reach(points: np.ndarray, queries: np.ndarray, eps: float) -> np.ndarray:
    """Which queries lie within eps of the box around the points."""
    low, high = points.min(axis=0), points.max(axis=0)
    gaps = np.maximum(np.maximum(low - queries, queries - high), 0)
    return (gaps * gaps).sum(axis=1) <= eps * eps * _SPARE


def within(points: np.ndarray, queries: np.ndarray, eps: float) -> np.ndarray:
    """(query, point): at most eps apart, by the sum the SQL expressions use."""
    squares, gaps = np.zeros((len(queries), len(points))), np.empty((len(queries), len(points)))
    for axis in range(points.shape[1]):
        np.subtract.outer(queries[:, axis], points[:, axis], out=gaps)
        np.multiply(gaps, gaps, out=gaps)
        np.add(squares, gaps, out=squares)
    return np.sqrt(squares, out=squares) <= eps


def _tiles(points: np.ndarray, queries: np.ndarray, eps: float, wanted):
    """(rows of points, rows of queries, hits) for boxes in reach; ``wanted(box, asking)`` tells which queries still ask a box."""
    for box in boxes(points):
        near = np.flatnonzero(_in_reach(points[box], queries, eps))
        near = near[wanted(box, near)]
        for start in range(0, len(near), ASKING_TILE):
            asking = near[start : start + ASKING_TILE]
            asking = asking[wanted(box, asking)]
            if len(asking):
                yield box, asking, within(points[box], queries[asking], eps)


def counts(points: np.ndarray, weights: np.ndarray, queries: np.ndarray, eps: float, enough: int, known: np.ndarray) -> np.ndarray:
    """The weight within eps of each query, added to what is known; exact below ``enough``, else at least that."""
    total = known.copy()
    for box, asking, hits in _tiles(points, queries, eps, lambda _, asking: total[asking] < enough):
        total[asking] += hits @ weights[box]
    return total


def own_counts(points: np.ndarray, weights: np.ndarray, asking: np.ndarray, eps: float, enough: int) -> np.ndarray:
    """:func:`counts` of the points ``asking`` among all points, each in its own box first."""
    total = np.zeros(len(points), int)
    every = boxes(points)
    for box in every:
        at = box[asking[box]]
        total[at] = counts(points[box], weights[box], points[at], eps, enough, total[at])
    for box in every:
        rest = asking & (total < enough)
        rest[box] = False
        at = np.flatnonzero(rest)
        at = at[_in_reach(points[box], points[at], eps)]
        total[at] = counts(points[box], weights[box], points[at], eps, enough, total[at])
    return np.where(asking, total, enough)


def _join(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The lowest row of each component once these rows are joined."""
    while True:
        left, right = root[left], root[right]
        apart = left != right
        if not apart.any():
            return root
        pairs = np.unique(np.minimum(left, right)[apart] * len(root) + np.maximum(left, right)[apart])
        left, right = pairs // len(root), pairs % len(root)
        np.minimum.at(root, right, left)
        while not np.array_equal(further := root[root], root):
            root = further


def joined(points: np.ndarray, groups: np.ndarray, eps: float) -> np.ndarray:
    """The lowest row of each component of points within eps of each other; points of a group, -1 for none, are one from the start."""
    root = np.arange(len(points))
    grouped = np.flatnonzero(groups >= 0)
    if len(grouped):
        _, first, group = np.unique(groups[grouped], return_index=True, return_inverse=True)
        root = _join(root, grouped, grouped[first][group])
    every = boxes(points)
    for apart in (False, True):
        for i, box in enumerate(every):
            for other in every[i + 1 :] if apart else [box]:
                asking = other[_in_reach(points[box], points[other], eps)]
                for start in range(0, len(asking), ASKING_TILE):
                    tile = asking[start : start + ASKING_TILE]
                    names = np.unique(root[box])
                    if len(names) == 1:
                        tile = tile[root[tile] != names[0]]
                    if len(tile):
                        left, right = np.nonzero(within(points[box], points[tile], eps))
                        root = _join(root, tile[left], box[right])
    return root


def linked(points: np.ndarray, labels: np.ndarray, queries: np.ndarray, asked: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (label of a query, label of a point) of different labels within eps, each once."""
    there, label = np.unique(labels, return_inverse=True)
    here, own = np.unique(asked, return_inverse=True)
    found = here[:, None] == there[None, :]
    same = found.copy()

    def wanted(box, asking):
        return ~found[np.ix_(own[asking], np.unique(label[box]))].all(axis=1)

    for box, asking, hits in _tiles(points, queries, eps, wanted):
        left, right = np.nonzero(hits)
        found[own[asking[left]], label[box[right]]] = True
    left, right = np.nonzero(found & ~same)
    return here[left], there[right]


def lowest(points: np.ndarray, values: np.ndarray, queries: np.ndarray, eps: float) -> np.ndarray:
    """The lowest value within eps of each query; the largest whole number where there is none."""
    none = np.iinfo(np.int64).max
    best = np.full(len(queries), none)
    for box, asking, hits in _tiles(points, queries, eps, lambda box, asking: best[asking] > values[box].min()):
        best[asking] = np.minimum(best[asking], np.where(hits, values[box][None, :], none).min(axis=1))
    return best
