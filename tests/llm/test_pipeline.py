"""Each stage on its own input, against brute force."""

from collections import Counter
from pathlib import Path

import pytest
from test_copies import plain_kept, plain_shingles
from test_rows import WORD, expected_targets

import corpus_pipeline
from tenderlens.llm.common import pick


def rows(df):
    return Counter(map(tuple, pick(df, "doc_id", "text", "lang", "source").collect()))


def test_stages(spark, documents, tmp_path):
    docs, tables = documents, []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(path)
        if name != "pack":
            assert spark.read.parquet(path).columns == docs.columns
        tables.append((docs, docs := spark.read.parquet(path)))
    (before, spoken), (_, distinct), (_, clean), (_, mixed), (_, packed) = tables

    kept = rows(spoken)
    assert kept == Counter({r: n for r, n in rows(before).items() if any(map(str.isalpha, r[1] or ""))})

    firsts = plain_kept([(d.doc_id, d.text) for d in spoken.collect()])
    assert rows(distinct) == Counter({r: n for r, n in kept.items() if r[0] in firsts})

    assert {r[0] for r in rows(clean)} == firsts
    assert all("@" not in r[1] or not WORD.search(r[1]) or "@mail" not in r[1] for r in rows(clean))

    sizes = Counter()
    for r in clean.collect():
        sizes[r.source] += len(WORD.findall(r.text))
    target, taken = expected_targets(sizes), Counter()
    assert set(rows(mixed)) <= set(rows(clean)) and max(rows(mixed).values()) <= 2
    for r in mixed.collect():
        taken[r.source] += len(WORD.findall(r.text))
    for source in sizes:
        largest = max(len(WORD.findall(r.text)) for r in clean.collect() if r.source == source)
        assert abs(taken[source] - target[source]) <= largest / 2 + 1e-6

    pieces = packed.collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter(r[0] for r in rows(mixed).elements())
    slots = Counter()
    for r in pieces:
        slots[r.sequence_id] += r.length
    assert max(slots.values()) <= 4096


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES])
def test_odd_tables(spark, odd, empty, stage):
    found = stage(spark, odd, "")
    if stage is not corpus_pipeline.pack_sequences:
        assert found.columns == odd.columns
    found.collect()
    assert stage(spark, empty, "").count() == 0


def test_near_copies_of_odd_rows(spark, odd):
    found = pick(corpus_pipeline.drop_near_copies(spark, odd, ""), "doc_id", "text").collect()
    sets = Counter(plain_shingles(r.text) for r in found)
    assert max(sets.values()) == 1
    assert set(sets) == {plain_shingles(r.text) for r in pick(odd, "text").collect()}


def test_intermediate_tables_go(spark, documents, tmp_path):
    """Each stage deletes what the one before left behind, but nothing that its documents still read."""
    from tenderlens.session import scratch_root

    def folders():
        return {p.name for p in Path(scratch_root(spark)).glob(f"tenderlens-{spark.sparkContext.applicationId}/*") if p.is_dir()}

    docs = documents.limit(30)
    before = folders()
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    mine = folders() - before
    assert mine
    mixed = corpus_pipeline.mix_sources(spark, kept, "")
    assert mixed.count() > 0 and folders() & mine < mine
    mixed.write.parquet(str(tmp_path / "mixed"))
    corpus_pipeline.identify_language(spark, spark.read.parquet(str(tmp_path / "mixed")), "")
    assert not folders() & mine


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"} <= set(rows[0].asDict())
