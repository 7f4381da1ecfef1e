"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Words are those of ``simhash``; a text of up to five words is one shingle. Texts with one and the same
set are one node. Candidates come from ``simhash``: nodes whose fingerprints on such shingles fall into one component, linked
through distances to the pivots. Edited copies differ in more bits than a search by fingerprint can allow, so
each node also has ``BANDS`` keys, every one made of ``ROWS`` minima of its set under random
orders: at a similarity s a pair shares none with a probability of (1 - s ** ROWS) ** BANDS, which is below 1e-9 from 0.8
on. Nodes that share a component or a key may be near copies. No pair becomes a link by that
alone: the sets themselves are compared.

A bit of the sketch says whether an odd number of the set's hashes fall on it, so two sets differ in at least
as many shingles as their sketches do in bits. Pairs that differ too much for the similarity are left out by
that, without loss.

Comparing all pairs of a large group of copies would take the square of its size. Nodes of a key are
compared with one of them first, the hub, round by round with another one. Links join components, and from then on a
place is (key, node, component): a key within one component is done. Rounds end when few pairs are left, or when a round
joins hardly any; then all pairs that share a key and are not connected yet are compared by size and sketch where
they meet, and the rest by their sets. Pairs left out by that lie within one component already.

Null texts and those of blanks have the empty set and are copies of each other.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderlens.llm import simhash
from tenderlens.llm.common import at, beside, pick, slices, unpacked
from tenderlens.operators.dbscan import components
from tenderlens.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 40
ROWS = 4
SEED = 42
SKETCH = 1024  # bits
MOST_BROADCAST = 500_000  # rows of a few numbers each
BLOCK = 4096  # shingles put in all orders at once
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray, more: np.ndarray) -> np.ndarray:
    values = (values ^ more) * _ODD
    return values ^ (values >> np.uint64(29))


def shingle_set(raw: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct 64-bit hashes of the shingles of a UTF-8 text, in ascending order."""
    import xxhash

    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    wide = min(shingle, len(words))
    found = np.full(len(words) - wide + 1, SEED, np.uint64)
    for i in range(wide):
        found = _mixed(found, hashed[i : i + len(found)])
    return np.unique(found)


def band_keys(own: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A key per band: hashes of ``rows`` minima of the set under random orders."""
    if not len(own):
        return np.zeros(0, np.int64)
    draw = np.random.default_rng(SEED)
    factors = draw.integers(0, 1 << 63, (bands * rows, 1), np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.min([(own[i : i + BLOCK] * factors).min(axis=1) for i in range(0, len(own), BLOCK)], axis=0).reshape(bands, rows)
    keys = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        keys = _mixed(keys, least[:, i])
    return keys.view(np.int64)


def sketch(own: np.ndarray) -> np.ndarray:
    """Parities of the numbers of hashes in ``SKETCH`` equal ranges, as 64-bit integers."""
    odd = np.bincount((own >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _signed(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, digest, fp, size, sketch, keys) of every row, written once."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches):
            texts = [raw or b"" for raw in batch.column(2).cast("binary").to_pylist()]
            sets = [shingle_set(raw, shingle) for raw in texts]
            prints = pa.array(np.array([simhash.fingerprint(raw, shingle) for raw in texts], "<u8").view("<i8"))
            names = ["doc_id", "text_hash", "digest", "fp", "size", "sketch", "keys"]
            digests = pa.array([xxhash.xxh128_digest(own.tobytes()) for own in sets], pa.binary())
            keys = pa.array([band_keys(own) for own in sets], pa.list_(pa.int64()))
            sizes, sketches = pa.array(map(len, sets), pa.int64()), pa.array(map(sketch, sets), pa.list_(pa.int64()))
            arrays = [batch.column(0), batch.column(1), digests, prints, sizes, sketches, keys]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return materialise(slim.mapInArrow(signed, "doc_id bigint, text_hash bigint, digest binary, fp bigint, size bigint, sketch array<bigint>, keys array<bigint>"), "signed")


def _nodes(signed: DataFrame) -> DataFrame:
    """(node, digest, prints, first, size, sketch, keys) for each distinct set of shingles; ``first`` is its first row."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    distinct = signed.groupBy("digest").agg(F.collect_set("fp").alias("prints"), first, *[F.first(name).alias(name) for name in ("size", "sketch", "keys")])
    return materialise(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _fingerprint_keys(nodes: DataFrame) -> DataFrame:
    """(node, key): the components of linked fingerprints that nodes fall into."""
    prints = materialise(nodes.select("node", F.explode("prints").alias("fp")), "prints")
    roots = simhash.linked(prints.select("fp").distinct())
    return prints.join(roots, "fp", "left").select("node", F.xxhash64(F.lit("fp"), F.coalesce("root", "fp")).alias("key")).distinct()


def _few(table: DataFrame) -> DataFrame:
    """A stored table, sent to all tasks if its rows are few; joins with many shuffle."""
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def _named(table: DataFrame) -> DataFrame:
    return table.withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"})


def _on(rows: DataFrame, keys: DataFrame) -> Column:
    return rows.doc_id.eqNullSafe(keys.own_id) & (rows.text_hash == keys.own_hash)


def _once(rows: DataFrame, again: DataFrame | None) -> DataFrame:
    """One of all rows alike in id and text; ``again`` names those that are there more than once."""
    if again is None:
        return rows
    keys = _few(again)
    nth = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("doc_id"))
    single = rows.join(keys, _on(rows, keys), "left_semi").withColumn("nth", nth).filter("nth = 1").drop("nth")
    return rows.join(keys, _on(rows, keys), "left_anti").unionByName(single)


def _rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_hash) with all columns of ``docs`` in ``row``."""
    return beside(docs).withColumns({"doc_id": at(docs, "doc_id").cast("bigint"), "text_hash": F.xxhash64(at(docs, "text"))})


def _sets(docs: DataFrame, first: DataFrame, again: DataFrame | None, shingle: int) -> DataFrame:
    """(node, shingles) for the nodes of ``first`` (node, own_id, own_hash)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingle_set(raw or b"", shingle).view(np.int64) for raw in batch.column(1).cast("binary").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

    slim = pick(docs, "doc_id", "text")
    rows, keys = _rows(slim), _few(first)
    texts = _once(rows.join(keys, _on(rows, keys)).drop("own_id", "own_hash"), again)
    return materialise(texts.select("node", at(slim, "text").cast("string").alias("text")).mapInArrow(sets, "node bigint, shingles array<bigint>"), "sets")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v, ...) whose sets have that Jaccard similarity or more."""
    named = _few(materialise(pairs.select(F.col("u").alias("node")).unionAll(pairs.select("v")).distinct(), "asked"))
    there = sets.join(named, "node", "left_semi")
    met = pairs.join(there.select(F.col("node").alias("v"), F.col("shingles").alias("of_v")), "v")
    met = met.join(there.select(F.col("node").alias("u"), F.col("shingles").alias("of_u")), "u")
    met = met.select(*pairs.columns, (F.size("of_u") + F.size("of_v")).alias("sizes"), F.size(F.array_intersect("of_u", "of_v")).alias("shared"))
    return met.filter(F.col("shared") / (F.col("sizes") - F.col("shared")) >= similarity).select(*pairs.columns)


def _close(sizes: tuple[Column, Column], sketches: tuple[Column, Column], similarity: float) -> Column:
    """Sets of these sizes and sketches can be so similar."""
    near = F.least(*sizes) / F.greatest(*sizes) >= similarity
    apart = sum((F.bit_count(sketches[0][i].bitwiseXOR(sketches[1][i])) for i in range(SKETCH // 64)), F.lit(0))
    return near & (apart * (1 + similarity) <= (sizes[0] + sizes[1]) * (1 - similarity) + 1e-6)


def _open_keys(places: DataFrame, draw: int) -> DataFrame:
    """Keys (key, n, left, hub) that hold several components; ``left`` pairs of theirs are not connected."""
    groups = places.groupBy("key", "root").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64(F.lit(draw), "node").alias("draw"), "node", "root")).alias("hub"))
    left = (F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2
    keys = groups.groupBy("key").agg(F.count("*").alias("roots"), F.sum("n").alias("n"), left.alias("left"), F.min("hub").alias("hub"))
    return materialise(keys.filter("roots > 1").select("key", "n", "left", F.col("hub.node").alias("hub"), F.col("hub.root").alias("hub_root")), "keys")


def _joined(places: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places with the components that links (root_u, root_v) make of theirs, and (root, new) for those that change."""
    edges = materialise(links.select(F.col("root_u").alias("u"), F.col("root_v").alias("v")).distinct(), "edges")
    nodes = edges.select(F.col("u").alias("node")).unionAll(edges.select("v")).distinct()
    moved = components(nodes, edges).filter("node <> root").select(F.col("node").alias("root"), F.col("root").alias("new"))
    moved = materialise(moved, "moved")
    met = places.join(_few(moved), "root", "left")
    return met.select("key", "node", F.coalesce("new", "root").alias("root")), moved


def _roots(places: DataFrame, about: DataFrame, sets: DataFrame, similarity: float, hub_rounds: int | None) -> list[DataFrame]:
    """Steps (root, new) that lead, in turn, from nodes to their components; ``places`` is (key, node)."""
    places, steps, before, draw = places.withColumn("root", F.col("node")), [], None, 0
    u, v = (about.select(F.col("node").alias(s), *[F.col(name).alias(f"{name}_{s}") for name in ("size", "sketch")]) for s in "uv")
    close = _close((F.col("size_u"), F.col("size_v")), (F.col("sketch_u"), F.col("sketch_v")), similarity)
    while True:
        keys = _open_keys(places, draw)
        many, left = keys.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("left"), F.lit(0))).first()
        if not left:
            return steps
        # Keys with one component need no place any more.
        places = materialise(places.join(keys.select("key"), "key"), "places")
        by_hub = left > 2 * many and (before is None or left < 0.9 * before) and draw != hub_rounds
        if by_hub:
            met = places.join(keys.select("key", "hub", "hub_root"), "key").filter("root <> hub_root")
            pairs = met.select(F.col("node").alias("u"), F.col("hub").alias("v"), F.col("root").alias("root_u"), F.col("hub_root").alias("root_v"))
            pairs = pairs.distinct().join(u, "u").join(v, "v").filter(close)
        else:
            there = materialise(places.join(about, "node"), "there")
            a, b = (there.select("key", *[F.col(name).alias(f"{name}_{s}") for name in ("node", "size", "sketch", "root")]) for s in "uv")
            pairs = a.join(b, "key").filter((F.col("root_u") < F.col("root_v")) & close).withColumnsRenamed({"node_u": "u", "node_v": "v"})
        pairs = materialise(pairs.select("u", "v", "root_u", "root_v").distinct(), "pairs")
        places, moved = _joined(places, _similar(pairs, sets, similarity))
        steps.append(moved)
        if not by_hub:
            return steps
        before, draw = left, draw + 1


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, hub_rounds: int | None = None) -> DataFrame:
    """The first row of each component of similar texts, by id, with all columns of ``docs``.

    ``hub_rounds`` ends the rounds with hubs early; the result is the same.
    """
    signed = _signed(docs, shingle)
    again = materialise(signed.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "again")
    again = None if again.isEmpty() else _named(again)
    nodes = _nodes(signed)
    places = materialise(nodes.select("node", F.explode("keys").alias("key")).unionAll(_fingerprint_keys(nodes)), "keyed")
    shared = places.groupBy("key").agg(F.count("*").alias("nodes")).filter("nodes > 1").select("key")
    places = materialise(places.join(shared, "key"), "shared")
    # What follows is about nodes that share a key with another one.
    about = nodes.join(places.select("node").distinct(), "node", "left_semi")
    about = materialise(about.select("node", "size", "sketch", F.col("first.doc_id").alias("own_id"), F.col("first.text_hash").alias("own_hash")), "about")
    sets = _sets(docs, materialise(about.select("node", "own_id", "own_hash"), "firsts"), again, shingle)

    grouped = nodes.select("digest", "first", F.col("node").alias("root"))
    for moved in _roots(places, about.select("node", "size", "sketch"), sets, similarity, hub_rounds):
        grouped = grouped.join(_few(moved), "root", "left").select("digest", "first", F.coalesce("new", "root").alias("root"))
    grouped = materialise(grouped, "grouped")
    kept = grouped.join(grouped.groupBy("root").agg(F.min("first").alias("kept")), "root")
    rows = signed.select("digest", "doc_id", "text_hash").join(kept.select("digest", "kept"), "digest")
    first = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_hash") == F.col("kept.text_hash"))
    gone = _few(_named(materialise(rows.filter(~first).select("doc_id", "text_hash").distinct(), "gone")))
    rows = _rows(docs)
    return unpacked(_once(rows.join(gone, _on(rows, gone), "left_anti"), again).select("row"), docs)
