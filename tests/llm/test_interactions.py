"""The filter audit against removing documents one filter after the other."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlens.llm import interactions
from tenderlens.llm.common import pick

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_failures(text):
    words = WORD.findall(text)
    return "".join(
        name
        for name, failed in {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
        }.items()
        if failed
    )


def plain_audit(docs, labels):
    """docs: (doc_id, source, text); labels: (doc_id, quality, toxic)."""
    good = {d for d, quality, _ in labels if quality == 1}
    toxic = {d for d, _, bad in labels if bad == 1}
    firsts = {}
    for d, _, text in docs:
        if d is not None:
            firsts[text or ""] = min(d, firsts.get(text or "", d))
    rows = []
    for d, source, text in docs:
        failed = set(plain_failures(text or ""))
        if d is not None and d > firsts[text or ""]:
            failed.add("E")
        rows.append((source or "", failed, d is not None and d in good, d is not None and d in toxic))
    found = {}
    for part in {part for part, *_ in rows}:
        own = [row[1:] for row in rows if row[0] == part]
        sums = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone, kept = [r for r in left if name in r[0]], [r for r in left if name not in r[0]]
                failing = [r for r in own if name in r[0]]
                sums[name] += len(gone)
                found[part, order, step] = [len(kept), len(gone), len(failing) - len(gone), sum(r[0] == {name} for r in own), sum(r[1] for r in gone), sum(r[2] for r in gone)]
                left = kept
        for order, step in {(order, step) for p, order, step in found if p == part}:
            found[part, order, step].append(sums[order[step - 1]])
    return {key: tuple(values) for key, values in found.items()}


NAMES = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def audited(docs, labels, **options):
    rows = interactions.audit(interactions.flagged(docs, **options), labels).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[n] for n in NAMES) for r in rows}
    assert len(found) == len(rows)
    return found


def rows_of(df, *names):
    return [tuple(r) for r in pick(df, *names).collect()]


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0, "x"), (1, 0, 1, "x"), (2, None, None, None), (None, 1, 1, None), (3, 1, 1, "y"), (6, 0, 1, "y"), (6, 0, 1, "y"), (99, 1, 1, "z")]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int, `QUALITY` string")


# Few cells and probes: nearly every text looks repeated. Few bits of the hash: different texts share it.
@pytest.mark.parametrize("options", [{}, {"spread": 1, "probes": 1, "cells": 64}, {"hash_bits": 3}, {"hash_bits": 6, "cells": 32}])
@pytest.mark.parametrize("table", ["documents", "odd", "empty"])
def test_audit(request, labels, table, options):
    docs = request.getfixturevalue(table)
    found = audited(docs, labels, **options)
    assert found == plain_audit(rows_of(docs, "doc_id", "source", "text"), rows_of(labels, "doc_id", "quality", "toxic"))


def test_large_group_of_copies(spark, labels):
    docs = spark.range(6000, numPartitions=7).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text " * 20).otherwise(F.concat(F.lit("own text "), F.col("id"), F.lit("é\U0001d4b3"))).alias("text"),
        (F.col("id") % 2).cast("string").alias("source"),
    )
    assert audited(docs, labels, cells=512) == plain_audit(rows_of(docs, "doc_id", "source", "text"), rows_of(labels, "doc_id", "quality", "toxic"))


def test_no_labels(documents, labels):
    found = audited(documents, labels.limit(0))
    assert all(values[4] == values[5] == 0 for values in found.values())


def test_sketch_clears_only_unique_texts(spark):
    draw = np.random.default_rng(1)
    own = draw.integers(-(1 << 62), 1 << 62, 20_000)
    many = np.concatenate([own, own[:500], own[:100]])
    hashes = spark.createDataFrame([(int(h),) for h in many], "hash bigint").repartition(5)
    segments, cells = 80, 1 << 12
    sketch = interactions.sketch(hashes, segments, cells)
    found = {r.hash for r in interactions.repeated(hashes, sketch, segments, cells).collect()}
    assert set(own[:500].tolist()) <= found
    assert len(found) < 500 + 0.02 * 20_000
    counts = np.stack([np.frombuffer(r.counts, np.uint8) for r in sketch.collect()])
    assert counts.max() == 2 and counts.shape == (segments, cells)


def test_orders():
    steps = interactions.orders()
    assert len(steps) == 600 and len({(s["filter_order"], s["step"]) for s in steps}) == 600
