"""Exact order statistics that never gather a column in one place.

A quantile is interpolated from the values at two ranks, by one formula whatever the size.
Ranks of at most ``small`` values are read off in order; above that they are found by
narrowing: an approximate sketch proposes two cut
values around the wanted rank, one counting pass places the rank exactly against
them, and only the open interval between them is looked at again. Cut values are
counted apart from the interval, so a value that fills a third of the table ends
the search instead of stalling it. Each round keeps under one percent of the
interval, whatever the distribution.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from tenderlens.session import materialise

SMALL = 1_000_000
_GRID = 1000
_ACCURACY = 10_000


def exact_quantiles(df: DataFrame, targets: dict[str, tuple[Column, float]], small: int = SMALL):
    """Linear-interpolation quantiles, nulls ignored; None for a column without values.

    ``targets`` maps a result name to (value column, probability). The value columns are
    written once, so whatever they derive from is computed in a single pass; a column
    object that several targets share is written once as well.
    """
    columns = {id(column): column for column, _ in targets.values()}
    names = {key: f"v{i}" for i, key in enumerate(columns)}
    values = materialise(df.select(*[column.cast("double").alias(names[key]) for key, column in columns.items()]), "values")
    counts = values.agg(*[F.count(name).alias(name) for name in values.columns]).first().asDict()
    asked = {target: (names[id(column)], p) for target, (column, p) in targets.items()}

    places = {target: (name, p * (counts[name] - 1)) for target, (name, p) in asked.items() if counts[name]}
    wanted = {(name, rank): counts[name] for name, place in places.values() for rank in (math.floor(place), math.ceil(place))}
    at = values_at_ranks(values, wanted, small)
    found = {}
    for target, (name, place) in places.items():
        low, high = at[(name, math.floor(place))], at[(name, math.ceil(place))]
        found[target] = low + (high - low) * (place - math.floor(place))
    return {target: found.get(target) for target in targets}


def exact_quantile(df: DataFrame, column: Column, probability: float, small: int = SMALL):
    return exact_quantiles(df, {"q": (column, probability)}, small)["q"]


class _Search:
    """An open interval known to hold the value of one rank, with exact counts around it."""

    def __init__(self, name, rank, count):
        self.name, self.rank, self.inside = name, rank, count
        self.low = self.high = self.value = None
        self.cuts = None

    def interval(self):
        value = F.col(self.name)
        keep = value.isNotNull()
        if self.low is not None:
            keep &= value > F.lit(self.low)
        if self.high is not None:
            keep &= value < F.lit(self.high)
        return F.when(keep, value)

    def propose(self, grid):
        step = self.rank / max(self.inside - 1, 1) * (len(grid) - 1)
        self.cuts = grid[max(math.floor(step) - 2, 0)], grid[min(math.ceil(step) + 2, len(grid) - 1)]

    def count_exprs(self):
        value, (a, b) = self.interval(), self.cuts
        return [
            F.count_if(value < a),
            F.count_if(value == a),
            F.count_if((value > a) & (value < b)),
            F.count_if((value == b) & (value > a)),
        ]

    def narrow(self, below, at_a, between, at_b):
        a, b = self.cuts
        if self.rank < below:
            self.high, self.inside = a, below
        elif self.rank < below + at_a:
            self.value = a
        elif self.rank < below + at_a + between:
            self.low, self.high, self.rank, self.inside = a, b, self.rank - below - at_a, between
        elif self.rank < below + at_a + between + at_b:
            self.value = b
        else:
            passed = below + at_a + between + at_b
            self.low, self.rank, self.inside = b, self.rank - passed, self.inside - passed


def values_at_ranks(values: DataFrame, wanted: dict[tuple[str, int], int], small: int = SMALL):
    """Values at zero-based ranks of non-null ascending order; ``wanted`` maps (column, rank) to its value count."""
    searches = {key: _Search(*key, count) for key, count in wanted.items()}
    while True:
        open_ = [s for s in searches.values() if s.value is None]
        if not open_:
            return {key: s.value for key, s in searches.items()}
        last = [s for s in open_ if s.inside <= small]
        if last:
            # At most ``small`` values are left in each interval, and ranks in one interval share its list.
            lists = {}
            for s in last:
                lists.setdefault((s.name, s.low, s.high), []).append(s)
            gathered = [F.sort_array(F.collect_list(own[0].interval())).alias(f"l{i}") for i, own in enumerate(lists.values())]
            picks = [F.col(f"l{i}")[s.rank].alias(f"p{i}_{j}") for i, own in enumerate(lists.values()) for j, s in enumerate(own)]
            row = values.agg(*gathered).select(*picks).first()
            for s, value in zip([s for own in lists.values() for s in own], row):
                s.value = value
            continue
        grid = [i / _GRID for i in range(_GRID + 1)]
        sketches = [F.percentile_approx(s.interval(), grid, _ACCURACY).alias(f"g{i}") for i, s in enumerate(open_)]
        for s, points in zip(open_, values.agg(*sketches).first()):
            s.propose(points)
        exprs = [e for s in open_ for e in s.count_exprs()]
        row = list(values.agg(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first())
        for i, s in enumerate(open_):
            s.narrow(*row[4 * i : 4 * i + 4])


def portable_hash(key: Column, seed: int) -> Column:
    """A 52-bit hash of a key that any SQL engine with md5 reproduces; exact as a double."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def sample_rows(df: DataFrame, key: Column, n: int, seed: int = 42, heap_rows: int = 10_000) -> DataFrame:
    """Exactly ``n`` rows chosen by hash order of the key; all rows when there are no more than ``n``.

    Up to ``heap_rows`` the rows come from per-partition heaps. Larger samples are cut at
    the exact n-th hash, so no task ever holds the sample.
    """
    hashed = df.withColumn("_hash", portable_hash(key, seed)).withColumn("_key", key)
    if n <= heap_rows:
        return hashed.orderBy("_hash", "_key").limit(n).drop("_hash", "_key")
    total = df.count()
    if total <= n:
        return df
    hashes = hashed.select(F.col("_hash").cast("double").alias("v0"))
    cut = int(values_at_ranks(hashes, {("v0", n - 1): total})[("v0", n - 1)])
    below = hashed.filter(F.col("_hash") < cut)
    room = n - below.count()
    ties = hashed.filter(F.col("_hash") == cut).orderBy("_key").limit(room)
    return below.unionByName(ties).drop("_hash", "_key")
