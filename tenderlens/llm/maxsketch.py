"""Ranked lexical search through hashed max-sketches.

A document's sketch holds, in every coordinate, the largest number of occurrences of its terms hashed there; a term
goes to one coordinate of each of ``ROWS`` hashes, and the smallest of those bounds its occurrences from above. The
impact of a term grows with its occurrences, so a query's looked-up impacts, times the weights of its terms, add up to
an upper bound of its score, never to less. A sketch has ``SPREAD`` coordinates or more for each distinct term.

Queries are asked in blocks of bounded size. A block's bounds are looked up for all documents at once. The documents
with the highest bounds are scored exactly on their whole texts first; the k-th of those scores is a threshold, and
every document whose bound reaches it is scored as well. No other document can be among the k highest.

Null texts, and those without a term, are no results and count nowhere. Every row is a document of its own, so repeated
rows are results each; among equal scores null ids come last. Rows of the query table that agree in id and text are one
query, those that agree in the id alone are ranked apart; queries without a term, or of null text, give no rows. Empty
tables give no rows; other columns are ignored.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tenderlens.llm.common import pick, slices
from tenderlens.session import materialise

K = 10
SPREAD = 16
ROWS = 2
MOST = 255  # a coordinate that holds it stands for any number of occurrences
FIRST = 64  # documents per query whose scores set the threshold
FIRST_PER_TASK = 16
BLOCK_QUERIES = 512
BLOCK_TERMS = 1 << 15  # with repeats; a longer query is a block of its own
CELLS = 1 << 21  # numbers in memory for one slice of documents
UNIT = 1_000_000_000

# A-Z in lower case, other letters, digits and bytes beyond ASCII as they are, all else blank.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    return raw.translate(_TERM_BYTES).split()


def coordinates(hashes: np.ndarray, size: int, row: int) -> np.ndarray:
    """Places of 32-bit term hashes in a sketch of ``size``, a power of two."""
    mixed = (hashes.astype(np.uint64) + np.uint64(row + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ mixed >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def _hashes(own: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, own), np.uint32, len(own))


def sketch(counts: dict[bytes, int], spread: int = SPREAD, rows: int = ROWS) -> np.ndarray:
    size = 1 << max(1, (spread * len(counts) - 1).bit_length())
    cells, hashes = np.zeros(size, np.uint8), _hashes(list(counts))
    many = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), MOST).astype(np.uint8)
    for row in range(rows):
        np.maximum.at(cells, coordinates(hashes, size, row), many)
    return cells


def impact(occurrences, length_norm):
    return UNIT * occurrences // (1000 * occurrences + 8 * length_norm)


def length_norm(n, documents: int, total: int):
    return 100 - 75 + 75 * n * documents // total


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _slim(docs: DataFrame) -> DataFrame:
    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def index(docs: DataFrame, spread: int = SPREAD, rows: int = ROWS) -> DataFrame:
    """(doc_id, text_hash, n, sketch) of every document with a term; ``n`` is its number of terms."""

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for i, raw in enumerate(batch.column(2).cast("binary").to_pylist()):
                if own := terms(raw or b""):
                    found.append((i, len(own), sketch(Counter(own), spread, rows).tobytes()))
            at, n, cells = zip(*found) if found else ((), (), ())
            kept = batch.take(pa.array(at, pa.int64()))
            arrays = [kept.column(0), kept.column(1), pa.array(n, pa.int64()), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_hash", "n", "sketch"])

    return materialise(_slim(docs).mapInArrow(folded, "doc_id bigint, text_hash bigint, n bigint, sketch binary"), "sketches")


class Block:
    """Some queries: distinct terms, and which query has which how often."""

    def __init__(self, queries: list[tuple[int, list[bytes]]]):
        self.queries = [number for number, _ in queries]
        self.counts = [Counter(own) for _, own in queries]
        self.terms = sorted(set().union(*self.counts))
        self.place = {term: i for i, term in enumerate(self.terms)}
        self.weights: list[int] = []

    def weigh(self, documents: int, holding: dict[int, int]) -> None:
        self.weights = [weight(documents, holding.get(i, 0)) for i in range(len(self.terms))]

    def matrix(self) -> np.ndarray:
        """Weight of each term in each query, times its occurrences there."""
        found = np.zeros((len(self.terms), len(self.queries)), np.float32)
        for q, counts in enumerate(self.counts):
            for term, many in counts.items():
                found[self.place[term], q] = many * self.weights[self.place[term]]
        return found


def blocks(queries: DataFrame, most_queries: int = BLOCK_QUERIES, most_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The queries (number, text), some at a time; the driver never holds more than a block and a row of them."""
    held, size = [], 0
    for row in queries.orderBy("number").toLocalIterator():
        own = terms(row.text.encode())
        if not own:
            continue
        # The matrix of a block is as wide as its queries and as high as its distinct terms.
        if held and (len(held) == most_queries or size + len(own) > most_terms):
            yield Block(held)
            held, size = [], 0
        held.append((row.number, own))
        size += len(own)
    if held:
        yield Block(held)


def holding(docs: DataFrame, block: Block) -> dict[int, int]:
    """Number of documents that hold each term of the block, by its place there."""
    places = block.place

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.zeros(len(places), np.int64)
        for batch in slices(batches):
            for raw in batch.column(0).cast("binary").to_pylist():
                for term in places.keys() & terms(raw or b""):
                    many[places[term]] += 1
        at = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(many[at])], names=["place", "documents"])

    found = _slim(docs).select("text").mapInArrow(counted, "place bigint, documents bigint")
    return {r.place: r.documents for r in found.groupBy("place").agg(F.sum("documents").alias("documents")).collect()}  # as many as the block has terms


def _bounds(batches: Iterator[pa.RecordBatch], block: Block, documents: int, total: int, rows: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of sketches with an upper bound per document and query."""
    matrix, hashes = block.matrix(), _hashes(block.terms)
    tries = np.arange(MOST + 1, dtype=np.int64)
    places: dict[int, list[np.ndarray]] = {}
    step = max(1, min(256, CELLS // max(len(block.terms), len(block.queries))))
    for batch in slices(batches, step):
        norms = length_norm(batch.column(2).to_numpy().astype(object), documents, total).astype(np.int64)
        impacts = impact(tries, norms[:, None])
        impacts[:, MOST] = UNIT // 1000
        looked = np.empty((batch.num_rows, len(block.terms)), np.float32)
        for i, raw in enumerate(batch.column(3)):
            cells = np.frombuffer(raw.as_buffer(), np.uint8)
            if len(cells) not in places:
                places[len(cells)] = [coordinates(hashes, len(cells), row) for row in range(rows)]
            own = cells[places[len(cells)][0]]
            for at in places[len(cells)][1:]:
                own = np.minimum(own, cells[at])
            looked[i] = impacts[i][own]
        # Products in single precision: the margin is far above the rounding of any sum of this length.
        yield batch, (looked @ matrix).astype(np.float64) * (1 + 1e-5 + 1e-7 * len(block.terms))


CANDIDATES = "number bigint, doc_id bigint, text_hash bigint, bound double"


def _candidates(batch: pa.RecordBatch, queries: np.ndarray, at: np.ndarray, q: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    kept = batch.take(pa.array(at, pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(queries[q]), kept.column(0), kept.column(1), pa.array(bounds[at, q])], names=["number", "doc_id", "text_hash", "bound"])


def highest(sketches: DataFrame, block: Block, documents: int, total: int, first: int = FIRST, rows: int = ROWS) -> DataFrame:
    """For each query, ``first`` documents with high bounds, up to ``FIRST_PER_TASK`` of one task."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, held = np.array(block.queries, np.int64), None
        for batch, bounds in _bounds(batches, block, documents, total, rows):
            keep = min(FIRST_PER_TASK, len(bounds))
            at = np.argpartition(-bounds, keep - 1, axis=0)[:keep]
            found = pa.Table.from_batches([_candidates(batch, queries, at.ravel(), np.tile(np.arange(len(queries)), keep), bounds)])
            held = found if held is None else pa.concat_tables([held, found])
            if held.num_rows > 8 * FIRST_PER_TASK * len(queries):
                held = _top(held, FIRST_PER_TASK)
        if held is not None:
            yield from _top(held, FIRST_PER_TASK).to_batches()

    found = sketches.mapInArrow(best, CANDIDATES).filter("bound >= 1")
    order = Window.partitionBy("number").orderBy(F.desc("bound"), F.xxhash64("doc_id", "text_hash"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= first).drop("place")


def _top(found: pa.Table, keep: int) -> pa.Table:
    number, bound = found.column("number").to_numpy(), found.column("bound").to_numpy()
    order = np.lexsort((-bound, number))
    begins = np.flatnonzero(np.r_[True, np.diff(number[order]) != 0])
    place = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
    return found.take(pa.array(order[place < keep]))


def reaching(sketches: DataFrame, block: Block, documents: int, total: int, least: dict[int, int], rows: int = ROWS) -> DataFrame:
    """Every pair whose bound is not below its query's threshold, and above 0."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = np.array(block.queries, np.int64)
        floor = np.array([max(1, least.get(number, 0)) for number in block.queries], np.float64)
        for batch, bounds in _bounds(batches, block, documents, total, rows):
            at, q = np.nonzero(bounds >= floor)
            yield _candidates(batch, queries, at, q, bounds)

    return sketches.mapInArrow(kept, CANDIDATES)


def scored(docs: DataFrame, pairs: DataFrame, block: Block, documents: int, total: int, least: dict[int, int]) -> DataFrame:
    """(number, doc_id, score) of candidates by their whole texts, as far as a score reaches its threshold and is above 0."""
    place, weights = block.place, block.weights
    counts = dict(zip(block.queries, block.counts))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc_id, raw, numbers in zip(batch.column(0).to_pylist(), batch.column(1).cast("binary").to_pylist(), batch.column(2).to_pylist()):
                own = terms(raw)
                norm, held = length_norm(len(own), documents, total), Counter(own)
                values = {term: weights[place[term]] * impact(held[term], norm) for term in place.keys() & held.keys()}
                for number in numbers:
                    score = sum(many * values.get(term, 0) for term, many in counts[number].items())
                    if score >= max(1, least.get(number, 0)):
                        out.append((number, doc_id, score))
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()) for values in columns], names=["number", "doc_id", "score"])

    # A text is asked for once, by all queries of the block that it may answer: never more than a block has.
    asked = pairs.groupBy("doc_id", "text_hash").agg(F.collect_set("number").alias("numbers"))
    asked = materialise(asked, "asked").withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"})
    slim = _slim(docs).filter("text is not null")
    met = slim.join(asked, slim.doc_id.eqNullSafe(asked.own_id) & (slim.text_hash == asked.own_hash))
    return met.select("doc_id", "text", "numbers").mapInArrow(exact, "number bigint, doc_id bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, spread: int = SPREAD, rows: int = ROWS, first: int = FIRST, most_queries: int = BLOCK_QUERIES, most_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents that score highest for each query of ``items`` (item_id, text)."""
    slim = pick(items, "item_id", "text").select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).filter("text is not null").distinct()
    queries = materialise(slim.withColumn("number", F.monotonically_increasing_id()), "queries")
    sketches = index(docs, spread, rows)
    documents, total = sketches.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    ranked = None
    for block in blocks(queries, most_queries, most_terms) if documents else ():
        block.weigh(documents, holding(docs, block))
        tried = scored(docs, highest(sketches, block, documents, total, first, rows), block, documents, total, {})
        kth = _ranked(tried, k).filter(F.col("rank") == k).select("number", "score").collect()  # a row per query of the block
        least = {row.number: row.score for row in kth}
        pairs = reaching(sketches, block, documents, total, least, rows)
        found = materialise(_ranked(scored(docs, pairs, block, documents, total, least), k), "ranked")
        ranked = found if ranked is None else ranked.unionAll(found)
    if ranked is None:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return ranked.join(queries.select("number", "item_id"), "number").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
