"""Near-duplicates by SimHash, linked through tables of distances to reference fingerprints.

A fingerprint has a bit for each bit of the shingle hashes that is set in over half of them.
Copies share a fingerprint, so all that follows works on distinct ones. Each gets its Hamming
distances to fixed references, the pivots. By the triangle inequality, two fingerprints at most
``bits`` apart differ by at most ``bits`` in every distance, so a pair whose largest coordinate
difference is above that is dropped, and what survives is compared bit by bit.

Distances to random references spread over some four units only, so joining on them alone would
come close to comparing all pairs. Pairs therefore meet where two of ``bits`` + 2 blocks of the
fingerprint agree, which no linked pair can fail to do, and the distances work on those.

Null and empty texts have fingerprint zero and are linked like any others. Components carry the
smallest id; null ids count only where a component has no other. Repeated rows all appear. An
empty table gives no rows; other columns are ignored.
"""

import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenderlens.llm.common import pick, slices
from tenderlens.operators.dbscan import components
from tenderlens.session import materialise

SHINGLE = 3
SEED = 42
BITS = 2
PIVOTS = 16


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def pivots(many: int = PIVOTS, seed: int = SEED) -> list[int]:
    """Fixed reference fingerprints, none near another."""
    draw = random.Random(seed)
    return [_signed(draw.getrandbits(64)) for _ in range(many)]


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text: A-Z in lower case, words between ASCII blanks, repeats included."""
    import xxhash

    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[: -shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    counts, total = np.zeros(64, np.int64), len(hashes)
    for at in range(0, total, 65536):
        block = np.array(hashes[at : at + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) with ``fp`` as a signed 64-bit integer."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(2).cast("binary").to_pylist()
            found = np.array([fingerprint(raw or b"", shingle) for raw in texts], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["doc_id", "text_hash", "fp"])

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return slim.mapInArrow(hashed, "doc_id bigint, text_hash bigint, fp bigint")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _block_masks(blocks: int) -> list[int]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def links(distinct: DataFrame, bits: int = BITS, many_pivots: int = PIVOTS) -> DataFrame:
    """(u, v), u < v: distinct fingerprints ``fp`` that differ in 1 to ``bits`` bits."""
    masks = _block_masks(bits + 2)
    table = F.array(*[_distance(F.col("fp"), F.lit(p)).cast("tinyint") for p in pivots(many_pivots)])
    tables = [
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(masks[i] | masks[j]))).alias("same"))
        for k, (i, j) in enumerate(itertools.combinations(range(bits + 2), 2))
    ]
    places = distinct.select("fp", table.alias("far")).select("fp", "far", F.inline(F.array(*tables)))
    a = places.select("k", "same", F.col("fp").alias("u"), F.col("far").alias("far_u"))
    b = places.select("k", "same", F.col("fp").alias("v"), F.col("far").alias("far_v"))
    apart = F.greatest(*[F.abs(F.col("far_u")[i] - F.col("far_v")[i]) for i in range(many_pivots)])
    met = a.join(b, (a.k == b.k) & (a.same == b.same) & (F.col("u") < F.col("v")) & (apart <= bits) & (_distance(F.col("u"), F.col("v")) <= bits))
    return met.select("u", "v").distinct()


def linked(distinct: DataFrame, bits: int = BITS, many_pivots: int = PIVOTS) -> DataFrame:
    """(fp, root): the lowest fingerprint of the component, for those of the distinct fingerprints that have a link."""
    edges = materialise(links(distinct, bits, many_pivots), "links")
    nodes = edges.select(F.col("u").alias("node")).unionAll(edges.select("v")).distinct()
    return components(nodes, edges).withColumnRenamed("node", "fp")


def _grouped(docs: DataFrame, bits: int, shingle: int, many_pivots: int):
    """Rows with their fingerprints; distinct fingerprints with their component's root; components with their first row."""
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    distinct = materialise(rows.groupBy("fp").agg(first, F.count("*").alias("copies")), "distinct")
    grouped = distinct.join(linked(distinct, bits, many_pivots), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return rows, grouped, grouped.groupBy("root").agg(F.min("first").alias("first"))


def classes(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, many_pivots: int = PIVOTS) -> DataFrame:
    """(doc_id, fp, component_id, copies) for every document; ``copies`` share the fingerprint."""
    rows, grouped, first = _grouped(docs, bits, shingle, many_pivots)
    named = grouped.drop("first").join(first, "root").select("fp", F.col("first.doc_id").alias("component_id"), "copies")
    return rows.join(materialise(named, "named"), "fp").select("doc_id", "fp", "component_id", "copies")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
