"""Token ids in ORC files, in ascending order of document id.

ORC stores the ids run-length encoded in stripes that readers take in parallel. Row
indexes and Bloom filters on ``doc_id`` let a search for documents skip stripes and row
groups by their metadata. Each row also has the number of ids before it within its part,
so that a document's place needs the totals of the parts only.

Null texts are empty: the end id alone. Null document ids come first; rows with the same
id follow each other by the hash of their text. An empty table gives files without rows.
Other columns are ignored.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tenderlens.llm import tokens
from tenderlens.llm.common import pick, slices
from tenderlens.session import materialise, scratch_path

END_ID = 2
SCHEMA = "doc_id bigint, ids array<int>, part int, before bigint"
OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
}


def _lists(chunks: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, chunks)]) // 4
    values = np.frombuffer(b"".join(chunks), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> str:
    """Encode whole texts and write them; returns the folder."""
    path = path or tokens.vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = tokens.encoder(path), TaskContext.get().partitionId(), 0
        end = end_id.to_bytes(4, "little")
        for batch in slices(batches):
            chunks = [encoder.encode(raw) + end for raw in tokens.raw_texts(batch.column(1))]
            starts = before + np.cumsum([0, *map(len, chunks)]) // 4
            before = int(starts[-1])
            arrays = [batch.column(0), _lists(chunks), pa.array([part] * len(chunks), pa.int32()), pa.array(starts[:-1], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "part", "before"])

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    # Equal ids are told apart by their text, so that no id makes a part large.
    order = [F.col("doc_id"), F.xxhash64("text")]
    sorted_ = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_.mapInArrow(encode, SCHEMA).write.options(**OPTIONS).mode("overwrite").orc(folder)
    return folder


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(folder)


def find(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of some documents; only stripes that may hold them are read."""
    return read(spark, folder).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: place of its first id, number of ids, checksum."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values, ends = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            arrays = [batch.column(0), *batch.columns[2:], pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "part", "before", "n_tokens", "ids_crc32"])

    rows = read(spark, folder).mapInArrow(measure, "doc_id bigint, part int, before bigint, n_tokens bigint, ids_crc32 bigint")
    rows = materialise(rows, "index")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    # One row per written part.
    totals = totals.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    joined = rows.join(materialise(totals, "bases"), "part")
    return joined.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` to the shared folder and read the figures back from the files."""
    folder = write(docs, scratch_path(docs.sparkSession, "tokens"), path, end_id)
    return index(docs.sparkSession, folder)
