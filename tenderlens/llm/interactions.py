"""How filters interact: what each removes in any order, alone, and at whose cost.

Four conditions read one text; the fifth, that a smaller id has the identical text, reads the table. Hashes of all
texts go into counting Bloom sketches first. A sketch is cut into segments that tasks count sparsely and that are merged
one by one, so none has to fit in one place. A text that finds a count of one in any of its cells occurs once. Only texts
that find more in all cells are shuffled, and their smallest id is found by the full text.

Each document ends as a mask of the conditions it fails. The masks are counted by part, and everything else is
added up from the numbers of documents that no filter of a set removes: 2^5 sums per part.

Null texts are empty, and so identical to empty ones. Null ids are neither smaller nor larger than others, so such rows
never fail E; rows of one id and one text do not fail because of each other. Several labels of one id count as one
that says what any of them says. A null source is the empty part. An empty table gives no rows; other columns are ignored.
"""

import itertools
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenderlens.llm.common import pick, slices
from tenderlens.session import materialise

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
SPREAD = 16  # cells of the sketch per document
PROBES = 3
SEGMENT = 1 << 18  # cells; a segment's counts are merged in one task
MOST_BROADCAST = 1_000_000  # hashes, of 8 bytes each

_UPPER = bytes(range(0x41, 0x5B))
_MARKS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))  # bytes that do not begin a code point


def failures(raw: bytes) -> int:
    """Bits of the conditions A to D that a UTF-8 text fails."""
    words = raw.split()
    points = len(raw.translate(None, _CONTINUED))
    failed = (
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * (len(raw) - len(raw.translate(None, _UPPER))) > 5 * points,
        len(raw) != len(raw.translate(None, _MARKS)),
    )
    return sum(bit << i for i, bit in enumerate(failed))


def _slim(docs: DataFrame, hash_bits: int) -> DataFrame:
    slim = pick(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("bigint"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return slim.withColumn("hash", F.shiftrightunsigned(F.xxhash64("text"), 64 - hash_bits) if hash_bits < 64 else F.xxhash64("text"))


def masks(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """(doc_id, part, hash, mask) with the bits of A to D."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array(map(failures, batch.column(3).cast("binary").to_pylist()), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], names=["doc_id", "part", "hash", "mask"])

    slim = _slim(docs, hash_bits).select("doc_id", "part", "hash", "text")
    return materialise(slim.mapInArrow(judged, "doc_id bigint, part string, hash bigint, mask int"), "masks")


def _mixed(hashes: np.ndarray) -> np.ndarray:
    found = hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (found ^ found >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)


def _cells(hashes: np.ndarray, segments: int, cells: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment, and ``probes`` cells within it, of each hash."""
    mixed = _mixed(hashes)
    first, step = mixed >> np.uint64(32), mixed & np.uint64(0xFFFFFFFF) | np.uint64(1)
    at = (first[:, None] + step[:, None] * np.arange(1, probes + 1, dtype=np.uint64)) % np.uint64(cells)
    return (_mixed(mixed) % np.uint64(segments)).astype(np.int64), at.astype(np.int64)


def _hash_chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[np.ndarray]:
    held = []
    for batch in batches:
        held.append(batch.column(0).to_numpy())
        if sum(map(len, held)) >= rows:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


CHUNK = 1 << 20  # hashes of a task at a time


def sketch(hashes: DataFrame, segments: int, cells: int = SEGMENT, probes: int = PROBES) -> DataFrame:
    """(segment, counts): for each cell 0, 1, or 2 for more, as one byte; ``hashes`` has a row per document."""

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _hash_chunks(batches, CHUNK):
            segment, at = _cells(own, segments, cells, probes)
            # A document counts once in a cell, also where two of its probes meet.
            at.sort(axis=1)
            new = np.ones(at.shape, bool)
            new[:, 1:] = at[:, 1:] != at[:, :-1]
            place, many = np.unique((segment[:, None] * cells + at)[new], return_counts=True)
            many = np.minimum(many, 2).astype(np.uint8)
            owner, begins = np.unique(place // cells, return_index=True)
            ends = [*begins[1:], len(place)]
            rows = [((place[a:b] % cells).astype("<u4").tobytes(), many[a:b].tobytes()) for a, b in zip(begins, ends)]
            places, counts = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), pa.array(places, pa.binary()), pa.array(counts, pa.binary())], names=["segment", "places", "many"])

    def merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint8)
        for batch in batches:
            for places, many in zip(batch.column("places"), batch.column("many")):
                at = np.frombuffer(places.as_buffer(), "<u4")
                total[at] = np.minimum(total[at] + np.frombuffer(many.as_buffer(), np.uint8), 2)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["segment", "counts"])

    parts = hashes.mapInArrow(sparse, "segment bigint, places binary, many binary")
    return materialise(parts.groupBy("segment").applyInArrow(merged, "segment bigint, counts binary"), "sketch")


def repeated(hashes: DataFrame, sketches: DataFrame, segments: int, cells: int = SEGMENT, probes: int = PROBES) -> DataFrame:
    """(hash): the distinct hashes that the sketch does not clear."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _hash_chunks(batches, CHUNK):
            own = np.unique(own)
            segment, _ = _cells(own, segments, cells, probes)
            order = np.argsort(segment, kind="stable")
            owner, begins = np.unique(segment[order], return_index=True)
            chunks = [own[part].tobytes() for part in np.split(order, begins[1:])] if len(own) else []
            yield pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), pa.array(chunks, pa.binary())], names=["segment", "hashes"])

    def asked(asking: pa.Table, answering: pa.Table) -> pa.Table:
        counts = np.frombuffer(answering.column("counts")[0].as_buffer(), np.uint8)
        # The distinct hashes of a segment are as few as its cells allow.
        own = np.unique(np.concatenate([np.frombuffer(row.as_buffer(), np.int64) for row in asking.column("hashes")]))
        _, at = _cells(own, segments, cells, probes)
        return pa.table({"hash": own[(counts[at] > 1).all(axis=1)]})

    questions = hashes.mapInArrow(packed, "segment bigint, hashes binary")
    return materialise(questions.groupBy("segment").cogroup(sketches.groupBy("segment")).applyInArrow(asked, "hash bigint"), "repeated")


def _met(rows: DataFrame, few: DataFrame, many: int, how: str) -> DataFrame:
    """A join on the hash that sends ``few`` everywhere only if its rows are few."""
    return rows.join(F.broadcast(few) if many <= MOST_BROADCAST else few, "hash", how)


def flagged(docs: DataFrame, spread: int = SPREAD, probes: int = PROBES, cells: int = SEGMENT, hash_bits: int = 64) -> DataFrame:
    """(doc_id, part, mask) for every document, with the bits of all five conditions."""
    facts = masks(docs, hash_bits)
    hashes = facts.select("hash")
    segments = max(1, -(-spread * facts.count() // cells))
    again = repeated(hashes, sketch(hashes, segments, cells, probes), segments, cells, probes)
    many = again.count()

    # Copies within a task are one row before the shuffle. The group is the full text, its hash only deals it out.
    texts = _met(_slim(docs, hash_bits), again, many, "left_semi").groupBy("hash", "text").agg(F.min("doc_id").alias("first"))
    texts = materialise(texts, "texts")
    # Nearly always a hash stands for one text; where it does not, its rows are met again by their texts.
    firsts = materialise(texts.groupBy("hash").agg(F.min("first").alias("first"), F.count("*").alias("texts")), "firsts")
    shared = materialise(firsts.filter("texts > 1").select("hash"), "shared")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))

    def with_bit(rows: DataFrame) -> DataFrame:
        return rows.select("doc_id", "part", (F.col("mask") + F.when(later, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))

    plain = with_bit(_met(facts, firsts, many, "left").filter("texts is null or texts = 1"))
    same = shared.count()
    rows = _met(_slim(docs, hash_bits), shared, same, "left_semi")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array(map(failures, batch.column(3).cast("binary").to_pylist()), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=["doc_id", "part", "hash", "text", "mask"])

    rows = rows.select("doc_id", "part", "hash", "text").mapInArrow(judged, "doc_id bigint, part string, hash bigint, text string, mask int")
    by_text = with_bit(rows.join(_met(texts, shared, same, "left_semi"), ["hash", "text"]))
    return plain.unionAll(by_text)


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, kept, good, toxic): documents, and those labelled good and toxic."""
    said = pick(labels, "doc_id", "quality", "toxic").select(F.col("doc_id").cast("bigint"), "quality", "toxic").filter("doc_id is not null")
    said = said.groupBy("doc_id").agg(*[F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c) for c in ("quality", "toxic")])
    met = rows.join(said, "doc_id", "left")
    return met.groupBy("part", "mask").agg(
        F.count("*").alias("kept"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )


def orders(filters: str = FILTERS) -> list[dict]:
    """Each step of each order: the sets of filters before and after it, as bits."""
    steps = []
    for order in itertools.permutations(filters):
        before = 0
        for step, name in enumerate(order, 1):
            own = 1 << filters.index(name)
            steps.append({"filter_order": "".join(order), "step": step, "own": own, "before": before, "after": before | own})
            before |= own
    return steps


def audit(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step; ``rows`` are those of ``flagged``."""
    counts = materialise(mask_counts(rows, labels), "mask_counts")  # 32 rows a part at most
    left = [
        F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(used) == 0, F.col(name)).otherwise(0)) for used in range(ALL + 1)]).alias(name)
        for name in ("kept", "good", "toxic")
    ]
    steps = F.from_json(F.lit(json.dumps(orders())), "array<struct<filter_order:string,step:int,own:int,before:int,after:int>>")
    whole = counts.groupBy("part").agg(*left).select("*", F.inline(steps))

    def less(name: str, few: Column, more: Column) -> Column:
        return F.get(F.col(name), few) - F.get(F.col(name), more)

    removed = less("kept", F.col("before"), F.col("after"))
    failing = less("kept", F.lit(0), F.col("own"))
    alone = less("kept", F.lit(ALL).bitwiseXOR(F.col("own")), F.lit(ALL))
    # A set of filters goes before a given one, and the rest after it, in so many orders.
    ways = [math.factorial(used.bit_count()) * math.factorial(max(0, len(FILTERS) - 1 - used.bit_count())) for used in range(ALL + 1)]
    shares = [F.when(F.col("own").bitwiseAND(used) == 0, many * less("kept", F.lit(used), F.col("own").bitwiseOR(used))).otherwise(0) for used, many in enumerate(ways)]
    return whole.select(
        "part",
        "filter_order",
        "step",
        F.get("kept", F.col("after")).alias("kept"),
        removed.alias("removed"),
        (failing - removed).alias("redundant"),
        alone.alias("unique_fails"),
        less("good", F.col("before"), F.col("after")).alias("good_lost"),
        less("toxic", F.col("before"), F.col("after")).alias("toxic_lost"),
        sum(shares[1:], shares[0]).alias("shapley"),
    )
