"""Exact top-k by inner product, selected with global histograms of scores.

Components become integers, so scores are exact. Every query scores every candidate, block by
block. A round counts the scores of each query in ``BINS`` bins of the range that holds its k-th
best, adds the counts over all blocks, and goes on within the bin where the k-th falls; a block
sends only bins that can still hold it. When the range is one score wide, the last pass keeps what
lies above and, at the k-th score itself, the smallest ids.

Vectors that are null or hold null or non-finite components take no part. Vectors of another
length than the query's have no product with it and are no candidates of it. Rows with equal
ids are rows of their own; null ids are never queries and come after all others in ties. Fewer
candidates than k are all returned. An empty table gives no rows. Scores are exact up to 2^62 either
way; a pair with one beyond is an error, not a wrong number. Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tenderlens.llm.common import pick
from tenderlens.session import materialise

SCALE = 256
K = 5
BINS = 256
CANDIDATES = 8192  # vectors of a block
QUERIES = 512
STRIPE = 2048  # candidates scored at once
MOST = (1 << 62) - 2  # the range of all scores, and so any difference of two, fits a long
_LOWEST = -(1 << 62)

_VECTORS = "is_query boolean, part int, block int, dims int, uids binary, ids binary, cells binary, norm double"
_COUNTS = "uid bigint, bin int, scores bigint"
_FOUND = "uid bigint, query_id bigint, vec_id bigint, score bigint"
_NO_ID = np.iinfo(np.int64).max


def _packed(rows, scale):
    """Blocks of vectors: ids, own numbers, and cells of 4 bytes, or of 8 where a number needs it."""
    uids, ids, cells = zip(*rows)
    cells = np.floor(scale * np.stack(cells))
    norm = float(np.sqrt((cells**2).sum(axis=1)).max()) if cells.size else 0.0
    kind = "<i4" if not cells.size or np.abs(cells).max() < 2**31 else "<f8"
    return np.array(uids, "<i8").tobytes(), np.array(ids, "<i8").tobytes(), cells.astype(kind).tobytes(), norm


def vectors(table: DataFrame, vec_id: str, embedding: str, is_query, scale: int = SCALE) -> DataFrame:
    """All vectors in blocks; queries are there a second time, in blocks of their own."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, uid, open_, blocks = TaskContext.get().partitionId(), 0, {}, {}

        def emit(key):
            asked, dims = key
            blocks[key] = blocks.get(key, -1) + 1
            row = (asked, part, blocks[key], dims, *_packed(open_.pop(key), scale))
            return pa.RecordBatch.from_pylist([dict(zip([c.split()[0] for c in _VECTORS.split(", ")], row))], schema=schema)

        kinds = {"boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _VECTORS.split(", ")])
        for batch in batches:
            for id_, asked, values in zip(*[column.to_pylist() for column in batch.columns]):
                uid += 1
                if values is None or None in values:
                    continue
                cells = np.array(values, np.float64)
                if not np.isfinite(cells * scale).all():
                    continue
                row = ((part << 36) + uid, _NO_ID if id_ is None else id_, cells)
                for key, most in (((False, len(cells)), CANDIDATES), ((True, len(cells)), QUERIES))[: 1 + bool(asked)]:
                    open_.setdefault(key, []).append(row)
                    if len(open_[key]) == most:
                        yield emit(key)
        for key in list(open_):
            yield emit(key)

    slim = pick(table, vec_id, embedding).toDF("vec_id", "embedding")
    slim = slim.select(F.col("vec_id").cast("bigint"), is_query(F.col("vec_id")), F.col("embedding").cast("array<double>"))
    return materialise(slim.mapInArrow(pack, _VECTORS), "vectors")


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of the rows of a with those of b."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if bound < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    products = exact(a).dot(exact(b).T)
    if max(products.max(), -products.min()) > MOST:
        raise OverflowError("a score is beyond 2^62")
    return products.astype(np.int64)


def _cells(raw: bytes, many: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4" if len(raw) == 4 * many * dims else "<f8").reshape(many, dims)


class _Asked:
    """A block of queries as it comes with each pair."""

    def __init__(self, listed, dims):
        self.uids = np.array([q["uid"] for q in listed], np.int64)
        self.ids = np.array([q["query_id"] for q in listed], np.int64)
        self.low, self.high, self.need = (np.array([q[n] for q in listed], np.int64) for n in ("low", "high", "need"))
        self.cells = np.concatenate([_cells(q["cells"], 1, dims) for q in listed])
        self.width = np.maximum(1, -((self.low - self.high) // BINS))


def _each_pair(batches, ask):
    """Calls ``ask(queries, candidates' uids, ids, scores)`` for stripes of each pair; yields per pair."""
    for batch in batches:
        columns = batch.column(0), batch.column(1), batch.column(2), batch.column(3), batch.column(4)
        for i in range(batch.num_rows):
            dims, uids, ids, cells, listed = (column[i].as_py() for column in columns)
            uids, ids = np.frombuffer(uids, "<i8"), np.frombuffer(ids, "<i8")
            cells, asked = _cells(cells, len(uids), dims), _Asked(listed, dims)
            yield ask(asked, [(uids[a : a + STRIPE], ids[a : a + STRIPE], cells[a : a + STRIPE]) for a in range(0, len(uids), STRIPE)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def ask(asked, stripes):
        many = len(asked.uids)
        counts = np.zeros(many * BINS, np.int64)
        for uids, _, cells in stripes:
            scores = _scores(cells, asked.cells)
            inside = (scores >= asked.low) & (scores < asked.high) & (uids[:, None] != asked.uids)
            place, query = (scores - asked.low) // asked.width, np.broadcast_to(np.arange(many), scores.shape)
            counts += np.bincount((query * BINS + place)[inside], minlength=many * BINS)
        counts = counts.reshape(many, BINS)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        query, place = np.nonzero((counts > 0) & (above < asked.need[:, None]))
        arrays = [pa.array(asked.uids[query]), pa.array(place.astype(np.int32)), pa.array(counts[query, place])]
        return pa.RecordBatch.from_arrays(arrays, names=["uid", "bin", "scores"])

    yield from _each_pair(batches, ask)


def _take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def ask(asked, stripes):
        found = []
        for uids, ids, cells in stripes:
            scores = _scores(cells, asked.cells)
            other = uids[:, None] != asked.uids
            for which in ((scores > asked.low) & other, (scores == asked.low) & other):
                row, query = np.nonzero(which)
                order = np.lexsort((ids[row], query))
                row, query = row[order], query[order]
                if which is not None and len(row):
                    # At the k-th score, a stripe sends as many of the smallest ids as are wanted.
                    first = np.searchsorted(query, query)
                    keep = (np.arange(len(row)) - first < asked.need[query]) | (scores[row, query] > asked.low[query])
                    row, query = row[keep], query[keep]
                    found.append((asked.uids[query], asked.ids[query], ids[row], scores[row, query]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
        ids = pa.array(columns[2], mask=columns[2] == _NO_ID)
        arrays = [pa.array(columns[0]), pa.array(columns[1]), ids, pa.array(columns[3])]
        return pa.RecordBatch.from_arrays(arrays, names=["uid", "query_id", "vec_id", "score"])

    yield from _each_pair(batches, ask)


def top_k(table: DataFrame, is_query, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score); ``is_query`` maps the id column to a condition."""
    packed = vectors(table, vec_id, embedding, lambda c: F.coalesce(is_query(c), F.lit(False)), scale)
    candidates = packed.filter("not is_query").select("part", "dims", "uids", "ids", "cells")
    parts = candidates.select("part", "dims").distinct()
    longest = packed.filter("not is_query").groupBy("dims").agg(F.max("norm").alias("longest"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                uids, ids = np.frombuffer(row["uids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                cells = _cells(row["cells"], len(uids), row["dims"])
                norms = np.sqrt((cells.astype(np.float64) ** 2).sum(axis=1))
                many = len(uids)
                arrays = [pa.array([row["part"]] * many, pa.int32()), pa.array([row["block"]] * many, pa.int32()), pa.array([row["dims"]] * many, pa.int32())]
                arrays += [pa.array(uids), pa.array(ids), pa.array([c.tobytes() for c in cells], pa.binary()), pa.array(norms)]
                yield pa.RecordBatch.from_arrays(arrays, names=["from_part", "block", "dims", "uid", "query_id", "cells", "norm"])

    queries = packed.filter("is_query").mapInArrow(unpack, "from_part int, block int, dims int, uid bigint, query_id bigint, cells binary, norm double")
    # No product is larger than that of the lengths.
    longest_product = F.col("norm") * F.col("longest") * (1 + 1e-12) + 1
    reach = F.when(longest_product >= float(MOST), F.lit(MOST)).otherwise(longest_product.cast("bigint")) + 1
    queries = queries.join(longest, "dims").withColumn("reach", reach).drop("norm", "longest")
    queries = materialise(queries.withColumns({"low": -F.col("reach"), "high": F.col("reach"), "need": F.lit(k).cast("bigint")}).drop("reach"), "queries")

    def pairs(asked: DataFrame, state: DataFrame | None) -> DataFrame:
        if state is not None:
            asked = asked.drop("low", "high", "need").join(state, "uid")
        fields = F.struct("uid", "query_id", "cells", "low", "high", "need")
        blocks = asked.groupBy("dims", "from_part", "block").agg(F.collect_list(fields).alias("listed"))  # at most QUERIES
        # The stated queries go to every part of the table, in blocks.
        sent = blocks.join(parts, "dims").select("dims", "part", "listed")
        return candidates.join(sent, ["part", "dims"]).select("dims", "uids", "ids", "cells", "listed")

    state = queries.select("uid", "low", "high", "need")
    while not state.filter("high - low > 1").isEmpty():
        open_ = pairs(queries, state.filter("high - low > 1"))
        counts = open_.mapInArrow(_count, _COUNTS).groupBy("uid", "bin").agg(F.sum("scores").alias("scores"))
        upto = F.sum("scores").over(Window.partitionBy("uid").orderBy(F.desc("bin")))
        counts = counts.select("uid", "bin", upto.alias("upto"), (upto - F.col("scores")).alias("above"))
        met = counts.join(state.select(F.col("uid").alias("own"), "need"), F.col("uid") == F.col("own")).filter("upto >= need")
        ends = met.groupBy("uid").agg(F.max(F.struct("bin", "above")).alias("at")).select("uid", "at.bin", "at.above")
        width = F.greatest(F.lit(1), F.expr(f"(high - low - 1) div {BINS} + 1"))
        joined = state.join(ends, "uid", "left")
        wide = F.col("high") - F.col("low") > 1
        low = F.when(~wide, F.col("low")).when(F.col("bin").isNull(), F.lit(_LOWEST)).otherwise(F.col("low") + F.col("bin") * F.col("width"))
        high = F.when(~wide, F.col("high")).when(F.col("bin").isNull(), F.lit(_LOWEST + 1))
        high = high.otherwise(F.least("high", F.col("low") + (F.col("bin") + 1) * F.col("width")))
        need = F.when(wide & F.col("bin").isNotNull(), F.col("need") - F.col("above")).otherwise(F.col("need"))
        joined = joined.withColumn("width", width.cast("bigint"))
        state = materialise(joined.select("uid", low.alias("low"), high.alias("high"), need.alias("need")), "state")
    found = pairs(queries, state).mapInArrow(_take, _FOUND)
    order = [F.desc("score"), F.asc_nulls_last("vec_id")]
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
