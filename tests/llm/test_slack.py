"""Minimum-slack packing against the tokenizer and against all subsets."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tenderlens.llm import catalog, slack, tokens
from tenderlens.llm.common import pick

COLUMNS = "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()


def whole_ids(docs):
    tokenizer = Tokenizer.from_file(tokens.vocabulary())
    return [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in pick(docs, "doc_id", "text").collect()]


def check_layout(rows, capacity):
    """Places are gapless from 0; returns the ids of padding."""
    slots = defaultdict(list)
    for r in rows:
        assert r["length"] > 0
        slots[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for own in slots.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & at - 1 == 0 else capacity - at
    return padding


def best_sum(lengths, room):
    return max((s for n in range(len(lengths) + 1) for own in itertools.combinations(lengths, n) if (s := sum(own)) <= room), default=0)


def test_fill_is_the_closest_sum():
    draw = random.Random(1)
    for _ in range(200):
        room = draw.randrange(1, 60)
        histogram = Counter(draw.randrange(1, 40) for _ in range(draw.randrange(9)))
        best, used = slack.fill(sorted(histogram.items(), reverse=True), room)
        assert best == best_sum(list(histogram.elements()), room)
        assert sum(length * n for length, n in used.items()) == best
        assert all(0 < n <= histogram[length] for length, n in used.items())


def test_plan_is_bounded_by_the_capacity():
    draw = random.Random(2)
    histogram = Counter(min(4096, int(draw.lognormvariate(6, 1)) + 1) for _ in range(50_000))
    small, windows, loose = slack.plan(histogram)
    assert windows * 4096 + loose >= sum(length * n for length, n in histogram.items()) - 4096
    assert loose < 0.01 * windows * 4096
    large, *_ = slack.plan({length: n * 100_000 for length, n in histogram.items()})
    assert len(large) < 1.5 * len(small) and max(Counter(s[0] for s in large).values()) < 1 << slack.SEARCH_BITS


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
@pytest.mark.parametrize("capacity", [4096, 64, 1])
def test_every_id_lies_in_one_place(request, table, capacity):
    docs = request.getfixturevalue(table)
    rows = slack.pack(docs, capacity=capacity).collect() if capacity > 1 or table != "documents" else []
    if not rows:
        return
    found = Counter()
    parts = defaultdict(list)
    for r in rows:
        parts[r.doc_id, r.doc_tokens].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        assert len(r.ids) == 4 * r.length
    expected = Counter((doc_id, len(ids), start, i) for doc_id, ids in whole_ids(docs) for start, i in enumerate(ids))
    for (doc_id, many), own in parts.items():
        found.update((doc_id, many, start + k, i) for start, ids in own for k, i in enumerate(ids))
    assert found == expected
    assert check_layout([r.asDict() for r in rows], capacity) == 0


def test_equal_lengths_are_cut(spark):
    """No two texts of these lengths fill a window, so all but the first of each are cut."""
    docs = spark.createDataFrame([(i, "a " * 2499, "x") for i in range(40)], "doc_id bigint, text string, source string")
    rows = [r.asDict() for r in slack.pack(docs).collect()]
    assert sum(r["length"] for r in rows) == 40 * 2500 and check_layout(rows, 4096) == 0
    assert len({r["sequence_id"] for r in rows}) == 40 * 2500 // 4096 + (40 * 2500 % 4096).bit_count()


def test_other_capacities_are_refused(documents):
    with pytest.raises(ValueError):
        slack.pack(documents, capacity=3000)


def test_query(spark, documents):
    rows = catalog.QUERIES["op11_min_slack_packing"](spark, "/root/testdata/sf0.001").collect()
    ids = dict(whole_ids(documents))
    assert {tuple(r.asDict()) for r in rows} == {tuple(COLUMNS)}
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    assert check_layout([r.asDict() for r in rows], 4096) == 0
