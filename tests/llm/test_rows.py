"""Mixing, quality, SimHash, top-k and language against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tenderlens.llm import catalog, language, mixing, quality, simhash, topk
from tenderlens.llm.common import pick, split_by_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_targets(size_of):
    names = sorted((s for s in size_of if s is not None), key=lambda s: s) + ([None] if None in size_of else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(size_of.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * size_of[s]}
        for s in full:
            target[s] = 2.0 * size_of[s]
            left -= target[s]
        if not full:
            target.update({s: level * weight[s] for s in open_})
            break
        open_ -= full
    return target


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_mixing(request, table):
    docs = request.getfixturevalue(table)
    rows = mixing.mix(docs).collect()
    source = [(d.doc_id, d.source, len(WORD.findall(d.text or ""))) for d in pick(docs, "doc_id", "source", "text").collect()]
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter(source)
    size_of, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, name, size in source:
        size_of[name] += size
        largest[name] = max(largest[name], size)
    target = expected_targets(size_of)
    for r in rows:
        assert r.source_size == size_of[r.source] and r.target == pytest.approx(target[r.source], rel=1e-12)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for name in size_of:
        assert abs(taken[name] - target[name]) <= largest[name] / 2 + 1e-6
    assert Counter(mixing.mix(docs.repartition(5)).collect()) == Counter(rows)


def test_larger_budgets_take_what_smaller_ones_take(spark, documents):
    sized = mixing.sizes(documents)
    kept = []
    for share in (0.1, 0.35, 0.8):
        budgets = sized.groupBy("source").agg((F.sum("size") * share).alias("budget"))
        plan = mixing.thresholds(sized, budgets).withColumnRenamed("source", "own")
        below = F.shiftrightunsigned("hash", 64 - mixing.BITS * mixing.LEVELS) < F.col("prefix")
        met = sized.join(plan, F.col("source").eqNullSafe(F.col("own"))).filter(below)
        kept.append({row.doc_id for row in met.collect()})
    assert kept[0] < kept[1] < kept[2]


def plain_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    return len({i + o for i, w in enumerate(windows) if seen[w] > 1 for o in range(3)})


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_quality(request, table):
    docs = request.getfixturevalue(table)
    rows = quality.apply_policy(quality.ledger(docs)).collect()
    expected = Counter()
    for d in pick(docs, "doc_id", "text").collect():
        text = d.text or ""
        words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
        n, again = len(words), plain_repeats(words)
        failed = n < 50 or 100 * again > 50 * n
        expected[d.doc_id, n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), again, failed] += 1
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert Counter(tuple(r[n] for n in names) for r in rows) == expected
    assert all(not (r.kept and r.base_failed) for r in rows)


def test_ablation(documents):
    book = quality.ledger(documents)
    rows = [row.failure_bits for row in book.collect()]
    for found in quality.ablation(book, "v2").collect():
        bit, mask = 1 << list(quality.rules()).index(found["rule"]), quality.mask("v2")
        assert found.failed == sum(bool(b & bit) for b in rows)
        assert found.failed_alone == sum(b & mask == bit for b in rows)
        assert found.kept_without == sum(b & mask & ~bit == 0 for b in rows)
        assert found.n_docs == len(rows)


def plain_fingerprint(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = WORD.findall(words)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """pairs: (doc_id, fingerprint)."""
    parent = {fp: fp for _, fp in pairs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    lowest = {}
    for doc_id, fp in pairs:
        if doc_id is not None:
            lowest[root(fp)] = min(doc_id, lowest.get(root(fp), doc_id))
    return Counter((doc_id, fp, lowest.get(root(fp))) for doc_id, fp in pairs)


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_simhash(request, table):
    docs = request.getfixturevalue(table)
    pairs = [(d.doc_id, plain_fingerprint(d.text)) for d in pick(docs, "doc_id", "text").collect()]
    rows = simhash.classes(docs).collect()
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in rows) == plain_components(pairs)


def test_links_lose_no_pair(spark):
    draw = np.random.default_rng(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(30):
        base = int(draw.integers(0, 2**63)) * 2
        fps |= {base ^ sum(1 << int(b) for b in draw.choice(64, k, replace=False)) for k in (0, 1, 1, 2, 2, 3, 4)}
    distinct = spark.createDataFrame([(simhash._signed(fp),) for fp in fps], "fp bigint")
    found = {frozenset((r.u % (1 << 64), r.v % (1 << 64))) for r in simhash.links(distinct).collect()}
    assert found == {frozenset((a, b)) for a in fps for b in fps if 1 <= (a ^ b).bit_count() <= 2}


def plain_top(rows, every, k):
    kept = [(i, v) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for at, (query, own) in enumerate(kept):
        if query is None or query % every:
            continue
        scored = []
        for other, (vec_id, v) in enumerate(kept):
            if other != at and len(v) == len(own):
                a, b = np.floor(256 * np.array(v, float)), np.floor(256 * np.array(own, float))
                scored.append((-sum(int(x) * int(y) for x, y in zip(a, b)), vec_id is None, vec_id or 0))
        out += [(query, r + 1, None if none else vec_id, -score) for r, (score, none, vec_id) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def test_top_k(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=4).round(1).tolist()) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.0, 0.0]) for i in range(60)]
    rows += [(300, None), (305, [1.0, None, 0.0, 0.0]), (310, [float("nan"), 0.0, 0.0, 0.0]), (315, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [9.0, 9.0, 9.0, 9.0]), (400, [1.0, 2.0]), (401, [3.0, 1.0]), (405, []), (0, [0.5, 0.5, 0.0, 0.0]), (500, [3e6] * 4)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x"))
    found = topk.top_k(table.repartition(4), lambda c: c % 5 == 0)
    assert Counter(map(tuple, found.collect())) == plain_top(rows, 5, 5)
    assert topk.top_k(table.limit(0), lambda c: c % 5 == 0).count() == 0


def test_top_k_with_large_scores(spark):
    """Exact beyond what doubles tell apart, up to 2^62."""
    half = float(1 << 30)
    rows = [(0, [half, 0.0]), (1, [half, 0.0]), (2, [half - 1, 0.0]), (3, [half, -1 / 256]), (4, [half / 2, 3.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = topk.top_k(table, lambda c: c == 1, k=4, scale=1).collect()
    cells = [[int(np.floor(x)) for x in v] for _, v in rows]
    scores = sorted(((-(c[0] * cells[1][0] + c[1] * cells[1][1]), i) for i, c in enumerate(cells) if i != 1))
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]


def test_top_k_beyond_the_range_of_scores(spark):
    for component in (1e12, 1e300):
        table = spark.createDataFrame([(0, [component, 1.0]), (1, [component, 3.0])], "vec_id bigint, embedding array<double>")
        with pytest.raises(Exception, match="beyond 2\\^62"):
            topk.top_k(table, lambda c: c == 1, k=3).collect()


@pytest.mark.parametrize("copies, target", [(500, 3075), (300, 1025), (7, 30)])
def test_mixing_takes_some_of_equal_rows(spark, copies, target):
    """A source of rows alike in id and text comes as near to its budget as whole rows can."""
    rows = [(1, "one two three four five six seven eight", "a")] * copies + [(2, "x " * (copies * 8 * 9), "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    share = target * 4 / 3 / (copies * 8 + copies * 72)
    found = [r for r in mixing.mix(docs, share=share).collect() if r.source == "a"]
    assert len(found) == copies and abs(sum(r.taken for r in found) - found[0].target) <= 4
    texts = mixing.mixed(docs, share=share)
    assert sum(len(r.text.split()) for r in texts.collect() if r.source == "a") == sum(r.taken for r in found)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = catalog.QUERIES["op6_language"](spark, "/root/testdata/sf0.01").collect()
    lang = {row.doc_id: row.lang for row in docs.collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert len(rows) == len(lang) and np.mean([r.lang_pred == lang[r.doc_id] for r in held if r.lang_pred != "und"]) > 0.97


def test_language_of_odd_documents(odd, empty):
    model = language.learn(odd, split_by_id(F.col("doc_id"), 4) != 2)
    rows = language.identify(odd, model).collect()
    assert len(rows) == odd.count()
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4)} == {"und"}
    assert all(0 <= r.score <= 1 and r.lang_pred in ("und", "en", "de", "fr", "es") for r in rows)
    assert language.learn(empty, F.lit(True)) is None
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}


def test_more_languages_than_the_sample(spark):
    """Every language is learned, also where the sample is smaller than their number."""
    rows = [(i, f"{word} {word}{i} {word}{word}", f"l{i % 12}") for i in range(240) for word in ["abcdefghijkl"[i % 12] * 4]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.learn(docs, F.lit(True), sample=5)
    assert {name for family in model.families for name in family} == {f"l{i}" for i in range(12)}


def test_language_blocks_count_each_ngram_once(monkeypatch):
    text = "der schnelle braune fuchs springt über den hund"
    whole = language.vector(text)
    monkeypatch.setattr(language, "BLOCK", 7)
    assert np.allclose(whole, language.vector(text))
