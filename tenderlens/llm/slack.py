"""Packing with minimum slack per sequence.

Texts become pieces of at most ``capacity`` ids. Windows are filled one pattern after the other: the longest
piece left is set, and a subset-sum over the multiset of the other lengths, kept as the bits of one integer,
says which sums can be reached; the one closest to the room left is traced back to a number of pieces per
length. A pattern is used as often as the counts allow, so that at least one length falls below what the
pattern takes of it. That happens to a length at most once per halving of its count from ``capacity / length``
on, which bounds the number of patterns (about 10,000 for 4,096) whatever the corpus: the plan works on a histogram.

Sequences whose length is a power of two need no padding. Windows that are full or hold a power of two are
kept; the pieces of all others are laid end to end and cut where windows end, and what is left at the very end
becomes sequences of the powers of two it is made of. So nothing is padded, and only those pieces are cut.

Null texts are empty: the end id alone. Repeated rows and null ids are packed like any others; an empty table
gives no rows; other columns are ignored.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderlens.llm import tokens
from tenderlens.llm.common import let, pick, slices
from tenderlens.session import materialise, scratch_path

CAPACITY = 4096
END_ID = 2
PIECES = "doc_id bigint, doc_tokens bigint, start bigint, length bigint, part int, nth bigint, ids binary"
# Places of a length that a search in a sorted array can tell apart.
SEARCH_BITS = 15


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of at most ``capacity`` ids, ``nth`` of its length in task ``part``."""
    path = path or tokens.vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = tokens.encoder(path), TaskContext.get().partitionId(), {}
        end, step = end_id.to_bytes(4, "little"), 4 * capacity
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        names = ["doc_id", "doc_tokens", "start", "length", "part", "nth", "ids"]
        for batch in slices(batches):
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), tokens.raw_texts(batch.column(1))):
                ids = encoder.encode(raw) + end
                for start in range(0, len(ids), step):
                    own = ids[start : start + step]
                    length = len(own) // 4
                    nth = seen[length] = seen.get(length, -1) + 1
                    rows.append((doc_id, len(ids) // 4, start // 4, length, part, nth, own))
            yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names=names)

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.mapInArrow(cut, PIECES)


def fill(lengths: list[tuple[int, int]], room: int) -> tuple[int, dict[int, int]]:
    """The reachable sum closest to ``room`` and the number of each length in it.

    ``lengths`` has (length, count) in the order in which they are offered. Bit s of ``reach`` says that some of
    those offered so far add up to s. Counts are offered in chunks of 1, 2, 4, ..., so any number up to the
    count can be put together; the bits before each chunk are kept for the way back.
    """
    reach, goal, mask, steps = 1, 1 << room, (1 << room + 1) - 1, []
    for length, count in lengths:
        left, chunk = min(count, room // length), 1
        while left:
            many = min(chunk, left)
            steps.append((reach, length, many))
            reach |= reach << many * length & mask
            left, chunk = left - many, 2 * chunk
        if reach & goal:
            break
    best = at = reach.bit_length() - 1
    used: dict[int, int] = {}
    for before, length, many in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + many
            at -= many * length
    return best, used


def unpadded(length: int, capacity: int) -> bool:
    return length == capacity or length & length - 1 == 0


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int, int]:
    """Slots, number of whole windows, and ids to lay end to end.

    A slot (length, first rank, first window, pieces per window, offset, base): the pieces of a length from that rank
    to the next slot's lie so many to a window from the offset on; or, where ``base`` is not null, end to end
    from that place on.
    """
    left = {length: histogram[length] for length in sorted(histogram, reverse=True)}
    slots, rank, windows, loose = [], dict.fromkeys(left, 0), 0, 0
    while left:
        longest, count = next(iter(left.items()))
        others = [(length, n - (length == longest)) for length, n in left.items()]
        best, used = fill([(length, n) for length, n in others if n and length <= capacity - longest], capacity - longest)
        used = {longest: used.get(longest, 0) + 1} | {length: n for length, n in used.items() if length != longest}
        times = min(left[length] // n for length, n in used.items())
        kept, offset = unpadded(longest + best, capacity), 0
        for length, n in used.items():
            slots.append((length, rank[length], windows, n, offset, None if kept else loose))
            rank[length] += times * n
            offset += n * length
            if not kept:
                loose += times * n * length
            left[length] -= times * n
            if not left[length]:
                del left[length]
        windows += times * kept
    return slots, windows, loose


def _place(sorted_ranks: Column, rank: Column) -> Column:
    """Index of the last of some ascending numbers, the first being 0, that is not above ``rank``."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(SEARCH_BITS))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(sorted_ranks, at + step) <= rank, at + step).otherwise(at))


def _cuts(at: Column, length: Column, windows: int, loose: int, capacity: int) -> Column:
    """(window, offset, from, to) for each window that a piece at this place of the ids laid end to end reaches into."""
    full = loose // capacity
    tails, start = [], full * capacity
    for bit in reversed(range(capacity.bit_length())):
        if loose % capacity >> bit & 1:
            tails.append((full + len(tails), start, start + (1 << bit)))
            start += 1 << bit
    first = F.floor(at / capacity).cast("bigint")
    spans = [(first + i, (first + i) * capacity, F.least((first + i + 1) * capacity, F.lit(full * capacity))) for i in (0, 1)]
    spans += [tuple(map(F.lit, tail)) for tail in tails]

    def part(window, begin, end):
        a, b = F.greatest(at, begin), F.least(at + length, end)
        return F.struct((window + windows).cast("bigint").alias("window"), (a - begin).cast("bigint").alias("offset"), (a - at).cast("bigint").alias("from"), (b - at).cast("bigint").alias("to"))

    return F.filter(F.array(*[part(*span) for span in spans]), lambda p: p["from"] < p["to"])


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, doc_tokens, start, length, ids, sequence_id, offset): the pieces and where they lie.

    ``ids`` are little-endian unsigned 32-bit integers. ``capacity`` must be a power of two.
    """
    if capacity & capacity - 1:
        raise ValueError("the capacity must be a power of two")
    spark, folder = docs.sparkSession, scratch_path(docs.sparkSession, "pieces")
    pieces(docs, path, capacity, end_id).write.option("compression", "zstd").parquet(folder)
    cut = spark.read.schema(PIECES).parquet(folder)
    sizes = materialise(cut.groupBy("part", "length").agg(F.count("*").alias("pieces")), "sizes")
    histogram = sizes.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()  # at most ``capacity`` rows
    slots, windows, loose = plan({row.length: row.pieces for row in histogram}, capacity)
    slots = spark.createDataFrame(slots, "length bigint, rank bigint, window bigint, each bigint, offset bigint, base bigint")
    places = F.array_sort(F.collect_list(F.struct("rank", "window", "each", "offset", "base")))
    # Some thousand slots at most, by the bound on patterns.
    slots = F.broadcast(slots.groupBy("length").agg(places.alias("slots")))

    before = F.sum("pieces").over(Window.partitionBy("length").orderBy("part")) - F.col("pieces")
    ranked = cut.join(sizes.select("part", "length", before.alias("before")), ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    found = ranked.join(slots, "length").withColumn("slot", F.get("slots", _place(F.transform("slots", lambda s: s["rank"]), F.col("rank"))))
    nth, own = F.col("rank") - F.col("slot.rank"), F.col("slot.offset")
    whole = F.struct(
        (F.col("slot.window") + F.floor(nth / F.col("slot.each"))).cast("bigint").alias("window"),
        (own + nth % F.col("slot.each") * F.col("length")).alias("offset"),
        F.lit(0).cast("bigint").alias("from"),
        F.col("length").alias("to"),
    )
    laid = let(F.col("slot.base") + nth * F.col("length"), lambda at: _cuts(at, F.col("length"), windows, loose, capacity))
    lying = found.select("doc_id", "doc_tokens", "start", "ids", F.inline(F.when(F.col("slot.base").isNull(), F.array(whole)).otherwise(laid)))
    return lying.select(
        "doc_id",
        "doc_tokens",
        (F.col("start") + F.col("from")).alias("start"),
        (F.col("to") - F.col("from")).alias("length"),
        F.substring("ids", (4 * F.col("from") + 1).cast("int"), (4 * (F.col("to") - F.col("from"))).cast("int")).alias("ids"),
        F.col("window").alias("sequence_id"),
        "offset",
    )
