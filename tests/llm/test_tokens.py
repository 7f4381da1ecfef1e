"""Packing, ORC files and edits against the tokenizer on whole texts."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tenderlens.llm import edits, orcfiles, packing, tokens
from tenderlens.llm.common import pick


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(tokens.vocabulary())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_is_the_tokenizer(documents, odd, whole):
    encoder = tokens.WordEncoder(tokens.vocabulary(), kept_words=300)
    texts = [row.text for row in pick(documents, "text").unionAll(pick(odd, "text")).collect() if row.text]
    for text in [*texts, "don't WE'LL 1st 2.5 a.b. ...", "Straße. naïve, ÿ. ×. x y z áb\x85c\x1cd"]:
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == whole(text)


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(request, whole, table, capacity):
    docs = request.getfixturevalue(table)
    rows = packing.best_fit(docs, capacity=capacity).collect()
    expected = Counter()
    for doc in pick(docs, "doc_id", "text").collect():
        ids = whole(doc.text) + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            expected[doc.doc_id, piece, start, len(own), crc(own)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    by = {}
    for row in rows:
        by.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for slots in by.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(by) >= -(-total // capacity)
    if table == "documents":
        assert len(by) <= 1.05 * total / capacity + 1


def test_plan_is_best_fit_decreasing():
    draw = random.Random(1)
    for _ in range(20):
        lengths = [draw.randint(1, 50) for _ in range(draw.randint(0, 400))]
        rooms = []
        for length in sorted(lengths, reverse=True):
            fitting = [i for i, room in enumerate(rooms) if room >= length]
            if fitting:
                rooms[min(fitting, key=lambda i: rooms[i])] -= length
            else:
                rooms.append(50 - length)
        slots = packing.plan(Counter(lengths), 50)
        assert max([first + -(-(to - start) // each) for _, start, to, first, each, _ in slots], default=0) == len(rooms)


def test_plan_does_not_grow_with_the_counts():
    small = packing.plan({length: 10 for length in range(1, 4097)})
    large = packing.plan({length: 10_000_000_019 for length in range(1, 4097)})
    assert len(large) < 20 * 4096 and len(small) < 20 * 4096


def test_sequences_hold_their_pieces(odd):
    cut = packing.pack(packing.pieces(odd, with_ids=True))
    packed = {row.sequence_id: row.ids for row in packing.sequences(cut).collect()}
    for row in cut.collect():
        own = packed[row.sequence_id][4 * row.offset : 4 * (row.offset + row.length)]
        assert zlib.crc32(own) == row.ids_crc32


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_orc_round_trip(request, spark, whole, table):
    docs = request.getfixturevalue(table)
    rows = orcfiles.round_trip(docs).collect()
    expected = Counter((d.doc_id, len(ids := whole(d.text) + [2]), crc(ids)) for d in pick(docs, "doc_id", "text").collect())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    at = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_orc_finds_documents(spark, documents, whole, tmp_path):
    folder = orcfiles.write(documents, str(tmp_path / "ids"))
    found = orcfiles.find(spark, folder, [7, 13])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    texts = {row.doc_id: row.text for row in documents.collect()}
    assert {row.doc_id: row.ids for row in found.collect()} == {i: whole(texts[i]) + [2] for i in (7, 13)}


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_edit_counts(request, whole, table):
    docs = request.getfixturevalue(table)
    made = edits.replacements(docs, "[0-9]+|o[a-z]* ", "0")
    rows = edits.apply_edits(edits.build_trees(made, None, 32, "edits"), state=True)
    expected = Counter()
    import re

    for doc in pick(docs, "doc_id", "text").collect():
        text = doc.text or ""
        after = re.sub("[0-9]+|o[a-z]* ", "0", text)
        expected[doc.doc_id, len(whole(text)), len(whole(after)), after] += 1
    assert Counter((r.doc_id, r.n_tokens_before, r.n_tokens, r.text) for r in rows.collect()) == expected


def test_edit_counts_in_one_pass(odd, empty):
    made = edits.replacements(odd, "[0-9]+", "0")
    apart = edits.apply_edits(edits.build_trees(made, None, edits.LEAF, "edits"))
    assert Counter(edits.counts_after(odd, "[0-9]+", "0").collect()) == Counter(apart.collect())
    assert edits.counts_after(empty, "[0-9]+", "0").count() == 0


def test_random_edits_keep_trees_right(whole):
    draw, pattern = random.Random(3), edits._leaves(3)
    count = lambda text: len(whole(text))
    for _ in range(60):
        text = "".join(draw.choice(["ab", "c", " ", "\n", "1", ".", "é"]) for _ in range(draw.randint(0, 60)))
        ends, sums = edits.grow(text, count, pattern)
        for _ in range(4):
            cuts = sorted(draw.sample(range(len(text) + 1), min(len(text) + 1, 2 * draw.randint(0, 3))))
            todo = [(a, b, draw.choice(["", "x", " ", "yz ", " q"])) for a, b in zip(cuts[::2], cuts[1::2])]
            new, at = [], 0
            for a, b, t in todo:
                new += [text[at:a], t]
                at = b
            expected = "".join(new) + text[at:]
            text, ends, sums, _ = edits.change(text, ends, sums, todo, count)
            assert text == expected and sums[1] == count(text)
            assert not ends or ends[-1] == len(text)
            half = len(sums) // 2
            assert [count(text[a:b]) for a, b in zip([0, *ends], ends)] == sums[half : half + len(ends)]


def test_edits_encode_little(whole):
    text = "word " * 10_000
    encoded = []
    ends, sums = edits.grow(text, lambda t: len(whole(t)), edits._leaves(32))
    edits.change(text, ends, sums, [(20_000, 20_004, "other")], lambda t: encoded.append(len(t)) or 0)
    assert sum(encoded) < 400


def test_edits_in_any_order(spark, whole):
    def after(text, todo):
        kinds = "doc_id bigint, text string, edits array<struct<start:int,end:int,text:string>>"
        made = spark.createDataFrame([(1, text, todo)], kinds)
        return edits.apply_edits(edits.build_trees(made, None, 2, "edits"), state=True).first()

    row = after("aa bb cc dd", [(6, 8, "xy"), None, (0, 2, ""), (3, 3, "one "), (3, 3, "two "), (11, 11, "!")])
    assert row.text == " one two bb xy dd!" and row.n_tokens == len(whole(row.text))
    for todo in ([(0, 4, "x"), (3, 5, "y")], [(6, 8, "x"), (0, 7, "y")], [(-1, 2, "x")], [(9, 12, "x")], [(5, 4, "x")]):
        with pytest.raises(Exception, match="overlap|before it starts"):
            after("aa bb cc dd", todo)
