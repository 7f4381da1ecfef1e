"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlens.llm import maxsketch
from tenderlens.llm.common import pick

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_scores(docs, item):
    """(score, doc_id) of every document (doc_id, text) for one query text."""
    docs = [(doc_id, Counter(own), len(own)) for doc_id, text in docs if (own := plain_terms(text))]
    n_docs, total = len(docs), sum(n for *_, n in docs)
    holding = Counter(term for _, own, _ in docs for term in own)
    asked = Counter(plain_terms(item))
    for doc_id, own, n in docs:
        m = 100 - 75 + 75 * n * n_docs // total
        score = 0
        for term, many in asked.items():
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
            score += many * w * (1_000_000_000 * own[term] // (1000 * own[term] + 8 * m))
        yield score, doc_id


def plain_search(docs, items, k=10):
    found = Counter()
    for item_id, text in set(items):
        if text is not None:
            best = sorted((-s, d is None, d if d is not None else 0) for s, d in plain_scores(docs, text) if s > 0)[:k]
            found.update((item_id, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(best, 1))
    return found


def rows_of(df, *names):
    return [tuple(r) for r in pick(df, *names).collect()]


def searched(docs, items, **more):
    return Counter(tuple(r) for r in maxsketch.search(docs, items, **more).select("item_id", "rank", "doc_id", "score").collect())


ITEMS = [
    (1, "Hello mail the quick fox"),
    (1, "Hello mail the quick fox"),
    (1, "another text of the same id"),
    (2, None),
    (None, "over over jumps 12"),
    (3, ""),
    (4, "... !"),
    (5, "unheardof"),
    (6, "İstanbul ΟΔΟΣ é 𝒳 endoftext"),
    (7, "one " * 500),
]


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, text, "x", 1) for i, text in ITEMS]
    return spark.createDataFrame(rows, "item_id bigint, text string, `TEXT` string, rank int")


@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
@pytest.mark.parametrize("options", [{}, {"spread": 1, "rows": 1, "first": 1, "most_queries": 2}, {"most_terms": 3}])
def test_all_documents(request, items, table, options):
    docs = request.getfixturevalue(table)
    assert searched(docs, items, **options) == plain_search(rows_of(docs, "doc_id", "text"), ITEMS)


def test_benchmark(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").limit(12)
    assert searched(docs, items, k=10, spread=4) == plain_search(rows_of(docs, "doc_id", "text"), rows_of(items, "item_id", "text"))


def test_no_queries(documents, items):
    assert maxsketch.search(documents, items.limit(0)).count() == 0
    assert maxsketch.search(documents, items.filter("item_id in (2, 3)")).count() == 0


def test_large_groups_of_ties(spark):
    """A third of all rows are copies with the highest score; the lowest ids win."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 2, "Hello fox").otherwise(F.concat(F.lit("word "), "id")).alias("text"))
    found = searched(docs, spark.createDataFrame([(1, "Hello fox")], "item_id bigint, text string"))
    assert [row[2] for row in sorted(found, key=lambda row: row[1])] == [3 * i + 2 for i in range(10)]


def test_bounds_are_never_below_scores(spark, documents):
    """For all pairs, with sketches so small that most coordinates are shared."""
    texts, items = rows_of(documents, "doc_id", "text"), rows_of(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"), "item_id", "text")
    for spread in (1, 16):
        sketches = maxsketch.index(documents, spread)
        n_docs, total = sketches.agg(F.count("*"), F.sum("n")).first()
        block = maxsketch.Block([(i, maxsketch.terms(text.encode())) for i, text in items])
        block.weigh(n_docs, maxsketch.holding(documents, block))
        bounds = {(r.number, r.doc_id): r.bound for r in maxsketch.reaching(sketches, block, n_docs, total, {}).collect()}
        for item_id, text in items[:10]:
            for score, doc_id in plain_scores(texts, text):
                assert score == 0 or bounds[item_id, doc_id] >= score


def test_more_occurrences_than_a_coordinate_holds(spark):
    docs = spark.createDataFrame([(1, "a " * 300 + "b"), (2, "a " * 254 + "c"), (3, "b c d " * 400)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b"), (2, "c d d")], "item_id bigint, text string")
    assert searched(docs, items) == plain_search(rows_of(docs, "doc_id", "text"), rows_of(items, "item_id", "text"))


def test_few_documents_are_scored(spark):
    """The threshold leaves out nearly all pairs."""
    draw = random.Random(1)
    texts = [(i, " ".join(f"w{int(draw.paretovariate(0.6))}" for _ in range(200))) for i in range(2000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    block = maxsketch.Block([(i, maxsketch.terms(text.encode())[:40]) for i, text in texts[::100]])
    sketches = maxsketch.index(docs)
    n_docs, total = sketches.agg(F.count("*"), F.sum("n")).first()
    block.weigh(n_docs, maxsketch.holding(docs, block))
    kth = defaultdict(list)
    for r in maxsketch.scored(docs, maxsketch.highest(sketches, block, n_docs, total), block, n_docs, total, {}).collect():
        kth[r.number].append(r.score)
    least = {number: sorted(own)[-10] for number, own in kth.items()}
    pairs = maxsketch.reaching(sketches, block, n_docs, total, least).count()
    assert pairs < 0.1 * 2000 * len(block.queries)


def test_sketch_keeps_the_largest():
    counts = {f"t{i}".encode(): i + 1 for i in range(100)}
    cells = maxsketch.sketch(counts, spread=2, rows=3)
    hashes = maxsketch._hashes(list(counts))
    for row in range(3):
        assert (cells[maxsketch.coordinates(hashes, len(cells), row)] >= np.arange(1, 101)).all()
