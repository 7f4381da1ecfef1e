"""Token counts that follow edits.

A text is cut between words into leaves of ``LEAF`` words. The document keeps a tree of
sums over the leaves' token counts. An edit re-encodes the leaves it touches, and the
next one too where the blank between them is gone; sums above those leaves are updated,
all others stay.

Null texts are empty and count 0; null or empty edits leave a document as it is. Edits are
(start, end, text) in code points of the present text, end exclusive, in any order; insertions at
one place follow each other as listed, and null edits are left out. Edits that overlap or leave the text are an error. Rows with repeated or null ids are handled alone.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tenderlens.llm import tokens
from tenderlens.llm.common import pick, slices

LEAF = 32
EDITS = "array<struct<start:int,end:int,text:string>>"
TREES = "doc_id bigint, text string, leaf_ends array<int>, sums array<int>"
COUNTS = "doc_id bigint, n_tokens_before bigint, n_tokens bigint, n_leaves bigint, n_encoded bigint"
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
_EDITS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))


def _leaves(leaf: int):
    return re.compile(rf"[{_BLANK}]*(?:[^{_BLANK}]+[{_BLANK}]*){{1,{leaf}}}|[{_BLANK}]+")


def _sums(counts: list[int]) -> list[int]:
    """Binary tree in one list: the children of i are 2i and 2i + 1, the total is at 1."""
    size = 1 << max(len(counts) - 1, 0).bit_length()
    sums = [0] * size + counts + [0] * (size - len(counts))
    for i in range(size - 1, 0, -1):
        sums[i] = sums[2 * i] + sums[2 * i + 1]
    return sums


def _set(sums: list[int], leaf: int, count: int) -> None:
    i = len(sums) // 2 + leaf
    change = count - sums[i]
    while i and change:
        sums[i] += change
        i //= 2


def grow(text: str, count, pattern) -> tuple[list[int], list[int]]:
    ends = [m.end() for m in pattern.finditer(text)]
    return ends, _sums([count(text[a:b]) for a, b in zip([0, *ends], ends)])


def change(text: str, ends: list[int], sums: list[int], edits: list[tuple[int, int, str]], count):
    """(text, ends, sums, leaves encoded) after the edits."""
    if not edits:
        return text, ends, sums, 0
    ends, sums, last, encoded = list(ends), list(sums), len(ends) - 1, 0
    if last < 0:
        text = "".join(new for _, _, new in edits)
        return text, [len(text)], _sums([count(text)]), 1
    parts, new_ends, done, shift, i = [], [], 0, 0, 0
    while i < len(edits):
        # The leaves of this edit, and of all later ones that reach them.
        first = min(bisect_right(ends, edits[i][0]), last)
        # A state after edits can have empty leaves at its end, behind a word.
        while first > len(new_ends) and text[ends[first - 1] - 1] not in _BLANK:
            first -= 1
        to, pieces, at = first, [], ends[first - 1] if first else 0
        while True:
            while i < len(edits) and (edits[i][0] < ends[to] or to == last):
                start, end, new = edits[i]
                pieces += [text[at:start], new]
                at, i = end, i + 1
                to = max(to, min(bisect_left(ends, end), last))
            whole = "".join(pieces) + text[at : ends[to]]
            if to == last or not whole or whole[-1] in _BLANK:
                break
            to += 1
        begin = ends[first - 1] if first else 0
        parts += [text[done:begin], whole]
        new_ends += [e + shift for e in ends[len(new_ends) : first]]
        shift += len(whole) - (ends[to] - begin)
        new_ends += [ends[to] + shift] * (to - first + 1)
        _set(sums, first, count(whole))
        for leaf in range(first + 1, to + 1):
            _set(sums, leaf, 0)
        encoded, done = encoded + to - first + 1, ends[to]
    parts.append(text[done:])
    new_ends += [e + shift for e in ends[len(new_ends) :]]
    return "".join(parts), new_ends, sums, encoded


def _in_order(edits, length: int) -> list[tuple[int, int, str]]:
    """Edits by place; those of one document must not touch the same code points."""
    listed = [(e["start"], e["end"], e["text"] or "") for e in edits or [] if e and e["start"] is not None and e["end"] is not None]
    listed.sort(key=lambda e: e[:2])
    for (_, before, _), (start, _, _) in zip([(0, 0, ""), *listed], [*listed, (length, length, "")]):
        if start < before:
            raise ValueError("edits overlap or lie outside of the text")
    if any(end < start for start, end, _ in listed):
        raise ValueError("an edit ends before it starts")
    return listed


def _counter(path):
    encode = tokens.encoder(path).encode
    return lambda text: len(encode(text.encode("utf-8", "replace"))) // 4


def _builder(path: str, leaf: int, keep: tuple[str, ...]):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, pattern = _counter(path), _leaves(leaf)
        for batch in slices(batches):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            grown = [grow(text, count, pattern) for text in texts]
            ends = pa.array([g[0] for g in grown], pa.list_(pa.int32()))
            sums = pa.array([g[1] for g in grown], pa.list_(pa.int32()))
            arrays = [batch.column(0), pa.array(texts, pa.string()), ends, sums, *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "leaf_ends", "sums", *keep])

    return build


def _follower(path: str, state: bool):
    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in slices(batches):
            out = []
            for doc_id, text, ends, sums, edits in zip(*[column.to_pylist() for column in batch.columns]):
                after, new_ends, new_sums, encoded = change(text, ends, sums, _in_order(edits, len(text)), count)
                out.append((doc_id, sums[1], new_sums[1], len(ends), encoded, *((after, new_ends, new_sums) if state else ())))
            kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            names = ["doc_id", "n_tokens_before", "n_tokens", "n_leaves", "n_encoded", "text", "leaf_ends", "sums"][: 8 if state else 5]
            arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return follow


def _finder(pattern: str, new: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = re.compile(pattern).finditer
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            found = [[{"start": m.start(), "end": m.end(), "text": new} for m in search(text or "")] for text in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _EDITS)], names=["doc_id", "text", "edits"])

    return find


def _slim(docs: DataFrame, *keep: str) -> DataFrame:
    kinds = {"doc_id": F.col("doc_id").cast("bigint"), "text": F.col("text").cast("string")}
    return pick(docs, "doc_id", "text", *keep).withColumns(kinds)


def build_trees(docs: DataFrame, path: str | None = None, leaf: int = LEAF, *keep: str) -> DataFrame:
    """The state of each document: text, leaf ends and sums; columns named in ``keep`` go along."""
    slim = _slim(docs, *keep)
    kinds = dict(slim.dtypes)
    schema = ", ".join([TREES, *[f"{name} {kinds[name]}" for name in keep]])
    return slim.mapInArrow(_builder(path or tokens.vocabulary(), leaf, keep), schema)


def apply_edits(trees: DataFrame, path: str | None = None, state: bool = False) -> DataFrame:
    """Counts before and after the column ``edits``; with ``state`` also the new text and tree."""
    slim = trees.select("doc_id", "text", "leaf_ends", "sums", "edits")
    schema = COUNTS + (", text string, leaf_ends array<int>, sums array<int>" if state else "")
    return slim.mapInArrow(_follower(path or tokens.vocabulary(), state), schema)


def replacements(docs: DataFrame, pattern: str, new: str) -> DataFrame:
    """``docs`` (doc_id, text) with ``edits`` that replace every match of a pattern."""
    return _slim(docs).mapInArrow(_finder(pattern, new), f"doc_id bigint, text string, edits {EDITS}")


def counts_after(docs: DataFrame, pattern: str, new: str, path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """Trees of all documents and their counts after replacing a pattern, in one pass and one process per task."""
    path = path or tokens.vocabulary()
    find, build, follow = _finder(pattern, new), _builder(path, leaf, ("edits",)), _follower(path, False)
    return _slim(docs).mapInArrow(lambda batches: follow(build(find(batches))), COUNTS)
