"""Near copies against brute force on whole sets of shingles."""

import random

import numpy as np
import pytest
from test_rows import WORD, plain_fingerprint

import corpus_pipeline
from tenderlens.llm import copies
from tenderlens.llm.common import pick

SCHEMA = "doc_id bigint, text string, lang string, source string"


def plain_shingles(text):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_kept(rows, similarity=0.8):
    """rows: (doc_id, text), ids distinct. The lowest id of each component, over all pairs."""
    sets, parent = {i: plain_shingles(text) for i, text in rows}, {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and plain_similarity(sets[a], sets[b]) >= similarity:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {root(x) for x in parent}


def table(spark, texts):
    return spark.createDataFrame([(i, text, "en", "a") for i, text in enumerate(texts)], SCHEMA)


def kept(found):
    return sorted(r.doc_id for r in found.collect())


def edited(words, at, draw):
    return [draw.choice(["red", "blue", "green"]) + str(i) if i in at else w for i, w in enumerate(words)]


def test_stage_drops_edited_copies(spark):
    draw, texts = random.Random(3), []
    for _ in range(30):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randrange(6, 400))]
        texts.append(" ".join(words))
        for edits in (1, 2, 4, 8):
            texts.append(" ".join(edited(words, draw.sample(range(len(words)), min(edits, len(words) - 1)), draw)))
    near = sum(plain_similarity(plain_shingles(a), plain_shingles(b)) >= 0.8 for i, a in enumerate(texts) for b in texts[:i])
    assert near > 50
    found = kept(corpus_pipeline.drop_near_copies(spark, table(spark, texts), ""))
    assert found == sorted(plain_kept(list(enumerate(texts))))


@pytest.mark.parametrize("hub_rounds", [0, 1, None])
def test_large_group(spark, hub_rounds):
    """Copies of which many are too far from each other, so one of them cannot stand for all."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(edited(words, draw.sample(range(100), draw.randrange(5)), draw)) for _ in range(120)]
    found = kept(copies.deduplicated(table(spark, texts), hub_rounds=hub_rounds))
    assert found == sorted(plain_kept(list(enumerate(texts))))


def test_alike_fingerprints_do_not_drop(spark):
    """Short texts with one fingerprint by three-word shingles, but other words."""
    draw, seen = random.Random(5), {}
    words = ["a", "b", "c", "d"]
    common = " ".join(["x y z"] * 40)
    texts = [f"{common} {' '.join(draw.choice(words) + str(draw.randrange(99)) for _ in range(12))} {common}" for _ in range(20)]
    for i, text in enumerate(texts):
        seen.setdefault(plain_fingerprint(text), []).append(i)
    assert any(len(own) > 1 for own in seen.values())
    found = kept(corpus_pipeline.drop_near_copies(spark, table(spark, texts), ""))
    assert found == sorted(plain_kept(list(enumerate(texts)))) == list(range(20))


def test_every_link_is_similar(spark, monkeypatch):
    """Over all links that drop a document at sf0.01."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found, plain = [], copies._similar

    def kept_links(pairs, sets, similarity):
        links = plain(pairs, sets, similarity)
        named = {r.node: frozenset(r.shingles) for r in sets.collect()}
        found.extend(plain_similarity(named[r.u], named[r.v]) for r in links.collect())
        return links

    monkeypatch.setattr(copies, "_similar", kept_links)
    copies.deduplicated(docs).count()
    assert found and min(found) >= 0.8


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in pick(docs, "doc_id", "text").collect()]
    assert kept(copies.deduplicated(docs)) == sorted(plain_kept(rows))


def test_odd_rows(spark, odd, empty):
    found = [plain_shingles(r.text) for r in pick(copies.deduplicated(odd), "text").collect()]
    assert len(found) == len(set(found)) and set(found) == {plain_shingles(r.text) for r in pick(odd, "text").collect()}
    assert copies.deduplicated(odd).columns == odd.columns
    assert copies.deduplicated(empty).count() == 0


def test_candidates_of_fingerprints(spark, monkeypatch):
    """With the keys of minima left out, copies with one word changed are found through their fingerprints."""
    monkeypatch.setattr(copies, "band_keys", lambda own: np.zeros(0, np.int64))
    draw = random.Random(6)
    words = [f"w{draw.randrange(10**6)}" for _ in range(3000)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(reversed(words))]
    assert kept(copies.deduplicated(table(spark, texts))) == [0, 2]
