"""The trie and its scores against plain counting."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlens.llm import ngrams
from tenderlens.llm.common import bucketed, pick, split_by_id


@pytest.mark.parametrize("many, most", [(0, 1), (1, 1), (3, 2**63), (5000, 40), (70_000, 2**40), (1500, 2**64 - 1)])
def test_elias_fano(many, most):
    values = np.sort(np.random.default_rng(many).integers(0, most, many, dtype=np.uint64, endpoint=False)) if many else np.zeros(0, "<u8")
    raw = ngrams.EliasFano.encode(values)
    code = ngrams.EliasFano(np.frombuffer(raw + b"more", np.uint8))
    assert code.size == len(raw) and (code.all() == values).all()
    for first, end in [(0, many), (many // 3, many // 2), (many // 2, many), (many, many)]:
        assert (code.slice(first, end) == values[first:end]).all()
    if many == 70_000:
        assert len(raw) < many * (math.log2(most / many) + 3) / 8


def test_level_finds_what_it_holds(monkeypatch):
    monkeypatch.setattr(ngrams, "BLOCK", 50)
    draw = np.random.default_rng(4)
    pairs = np.unique(draw.integers(0, 300, 4000) ** 2 // 300 * 1000 + draw.integers(0, 1000, 4000)).astype("<u8")
    held = draw.random(len(pairs)) < 0.5
    p = draw.random(len(pairs))
    raw = ngrams.Level.encode(pairs[held] // 1000, pairs[held] % 1000, p[held], 1000)
    place, found = ngrams.mapped(raw, lambda mapped: ngrams.Level(mapped, 1000).find(pairs // 1000, pairs % 1000))
    assert ((found > 0) == held).all() and (place[held] == np.arange(1, held.sum() + 1)).all() and not place[~held].any()
    assert np.allclose(np.log10(ngrams.PROBABILITIES[found[held]]), np.log10(p[held]), atol=ngrams.STEP / 2 + 1e-9)


def test_word_level_finds_what_it_holds(monkeypatch):
    monkeypatch.setattr(ngrams, "BLOCK", 70)
    draw = np.random.default_rng(6)
    hashes = np.unique(draw.integers(0, 1 << 63, 900, dtype=np.uint64) * np.uint64(2))
    held = draw.random(len(hashes)) < 0.6
    counts = draw.integers(1, 10**6, held.sum())
    raw = ngrams.WordLevel.encode(hashes[held], counts, 10**10)
    place, code = ngrams.mapped(raw, lambda mapped: ngrams.WordLevel(mapped).find(hashes))
    assert (place[held] == np.arange(1, held.sum() + 1)).all() and (place[~held] == 0).all() and (code[~held] == 0).all()
    shares = ngrams.word_shares(code, 10**10)
    assert np.allclose(np.log10(shares[held]), np.log10(counts + 0.1), atol=ngrams.STEP_WORD / 2 + 1e-9) and (shares[~held] == 0.1).all()
    nothing = ngrams.mapped(ngrams.WordLevel.encode(hashes[:0], counts[:0], 0), lambda mapped: ngrams.WordLevel(mapped).find(hashes))
    assert not nothing[0].any() and not nothing[1].any()


START = object()


def expected(rows, order):
    """By dictionaries of whole word sequences."""
    docs = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0, [w.lower() for w in (t or "").encode().split()] + [b""]) for i, t in rows]
    counts, learned = Counter(), 0
    for _, held, words in docs:
        if not held:
            marked = [START, *words]
            learned += len(words)
            for n in range(1, order + 1):
                counts.update(tuple(marked[i : i + n]) for i in range(len(marked) - n + 1))
    total, known = learned, sum(len(h) == 1 and h != (START,) for h in counts)
    once, all_ = Counter(), Counter()
    for h, c in counts.items():
        if len(h) > 1:
            kind = len(h), int(math.log2(counts[h[:-1]]))
            once[kind] += c == 1
            all_[kind] += c
    out = Counter()
    for doc_id, held, words in docs:
        base = score = 0.0
        marked = [START, *words]
        for i, w in enumerate(words, 1):
            p = (counts[w,] + 0.1) / (total + 0.1 * (known + 1))
            base += math.log10(p)
            for n in range(2, order + 1):
                context = tuple(marked[i - n + 1 : i]) if i >= n - 1 else None
                if context and counts[context] >= (1 if n == 2 else 2):
                    kind = n, int(math.log2(counts[context]))
                    b = min(max((once[kind] + 0.5) / (all_[kind] + 1), 0.01), 0.99)
                    p = (1 - b) * counts[*context, w] / counts[context] + b * p
            score += math.log10(p)
        out[doc_id, held, len(words), sum(counts[w,] > 0 for w in words), total, round(base, 4)] += 1
        out["score", doc_id, len(words)] += score
    return out


@pytest.mark.parametrize("chunk, order", [(300, 3), (1_000_000, 3), (300, 4), (1_000_000, 2)])
@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_scores(request, monkeypatch, table, chunk, order):
    monkeypatch.setattr(ngrams, "TOKENS", 2000)
    monkeypatch.setattr(ngrams, "WORDS", 3000)
    docs = request.getfixturevalue(table)
    wanted = expected([tuple(r) for r in pick(docs, "doc_id", "text").collect()], order)
    rows = ngrams.score(docs, split_by_id(F.col("doc_id"), 10) == 0, chunk, order).collect()
    got = Counter()
    for r in rows:
        got[r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)] += 1
    assert got == Counter({k: n for k, n in wanted.items() if k[0] != "score"})
    sums, alike = Counter(), Counter()
    for r in rows:
        sums["score", r.doc_id, r.n_tokens] += r.score
        alike["score", r.doc_id, r.n_tokens] += 1
    for key, value in sums.items():
        # Half a step of the 8-bit codes is 0.0157 per token.
        assert value == pytest.approx(wanted[key], abs=0.016 * key[2] * alike[key] + 1e-6)


def test_held_out_texts_score_better_than_by_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = ngrams.score(docs, split_by_id(F.col("doc_id"), 10) == 0).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_bucketed_tables_join_without_a_shuffle(spark):
    made = spark.range(1000).selectExpr("id % 7 as part", "id as chunk", "id * 3 as value")
    kept, asked = bucketed(made, "part", "kept", shuffle=False), bucketed(made.filter("id % 2 = 0").withColumnRenamed("value", "answer"), "part", "asked")
    hinted = ngrams.with_answers(kept, asked.groupBy("part", "chunk").agg(F.collect_list("answer").alias("answers")).hint("merge"), "left")
    plan = hinted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    got = {r.chunk: r.answers for r in hinted.collect()}
    assert got == {i: None if i % 2 else [3 * i] for i in range(1000)}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("kept_", "asked_"))]


@pytest.mark.parametrize("places", [[], [0, 0], [1], [0, 5, 0, 6, 900_000, 0]])
def test_rising_places_round_trip(places):
    assert ngrams._expand_rising(ngrams._squeeze_rising(np.array(places, np.int64))).tolist() == places
