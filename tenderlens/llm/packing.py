"""Best-fit packing planned on the histogram of lengths.

Texts become pieces of at most ``capacity`` ids. The plan packs counts, not pieces:
lengths are taken from long to short and each goes to the open sequences with the
least room that still fits, many at a time, since all sequences with the same room
are alike. A piece then takes the slot of its rank within its length. The histogram
has at most ``capacity`` rows whatever the corpus, and so the plan is bounded too.

Null texts are empty: one piece that holds the end id alone. Repeated rows and null ids
are packed like any others; an empty table gives no rows; other columns are ignored.
"""

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tenderlens.llm import tokens
from tenderlens.llm.common import pick, slices
from tenderlens.session import materialise

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids=False, kept_words: int = tokens.KEPT_WORDS) -> DataFrame:
    """One row per piece: its place in the document, and ``nth`` of its length in task ``part``."""
    path = path or tokens.vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = tokens.encoder(path, kept_words), TaskContext.get().partitionId(), {}
        end, step = end_id.to_bytes(4, "little"), 4 * capacity
        for batch in slices(batches):
            out = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids")}
            for doc_id, raw in zip(batch.column(0).to_pylist(), tokens.raw_texts(batch.column(1))):
                ids = encoder.encode(raw) + end
                for piece, start in enumerate(range(0, len(ids), step)):
                    own = ids[start : start + step]
                    length = len(own) // 4
                    nth = seen[length] = seen.get(length, -1) + 1
                    row = (doc_id, piece, start // 4, length, zlib.crc32(own), part, nth, own if with_ids else None)
                    for values, value in zip(out.values(), row):
                        values.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            arrays = [pa.array(values, kind) for values, kind in zip(out.values(), kinds)]
            yield pa.RecordBatch.from_arrays(arrays[: 7 + with_ids], names=list(out)[: 7 + with_ids])

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on counts.

    Rows (length, first rank, end rank, first sequence, pieces per sequence, offset): the
    pieces of these ranks fill the sequences from the first on, so many in each, from the
    offset on.
    """
    slots, opened = [], 0
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)
    rooms: list[int] = []

    def keep(room, first, many):
        if room and many:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((first, many))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]

        def place(room, first, many, each):
            nonlocal rank, left
            slots.append((length, rank, rank + many * each, first, each, capacity - room))
            rank, left = rank + many * each, left - many * each
            keep(room - each * length, first, many)

        while left:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, many = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[i]
            else:
                room, first, many = capacity, opened, -(-left // (capacity // length))
                opened += many
            each = room // length
            full = min(many, left // each)
            if full:
                place(room, first, full, each)
            if left and full < many:
                place(room, first + full, 1, left)
                full += 1
            keep(room, first + full, many - full)
    return slots


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with their sequence and the offset there."""
    spark = cut.sparkSession
    cut = materialise(cut, "pieces")
    sizes = materialise(cut.groupBy("part", "length").agg(F.count("*").alias("pieces")), "sizes")
    histogram = sizes.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()  # at most ``capacity`` rows
    slots = plan({row.length: row.pieces for row in histogram}, capacity)
    schema = "length bigint, from_rank bigint, to_rank bigint, first_sequence bigint, each bigint, from_offset bigint"
    slots = spark.createDataFrame(slots, schema)
    before = F.sum("pieces").over(Window.partitionBy("length").orderBy("part")) - F.col("pieces")
    ranked = cut.join(sizes.select("part", "length", before.alias("before")), ["part", "length"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth")).drop("part", "nth", "before")
    # The plan's size depends on the capacity, not on the input: a few slots for each length.
    placed = ranked.join(F.broadcast(slots), "length").filter("rank >= from_rank and rank < to_rank")
    place = F.col("rank") - F.col("from_rank")
    return placed.select(
        *[name for name in cut.columns if name not in ("part", "nth")],
        (F.col("first_sequence") + F.floor(place / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("from_offset") + place % F.col("each") * F.col("length")).alias("offset"),
    )


def best_fit(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(pieces(docs, path, capacity, end_id), capacity)


def sequences(packed_with_ids: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed ids as little-endian unsigned 32-bit integers; at most ``capacity`` a sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return packed_with_ids.groupBy("sequence_id").agg(joined.alias("ids"))
