"""Personal data against plain regular expressions."""

import hashlib
import random
import re
from collections import Counter

import pytest

from tenderlens.llm import catalog, private
from tenderlens.llm.common import pick

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "x@y.zz a@b.c_d@e.f..g@h-i.j.k @ a@b q@r. s@t.u",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1.2.3 9.9.9.9x 1..2.3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 5500005555555559 0000000000000000 12 3 4-5--6",
    "+1 (487) 555-7209 +49 30 123456 +1( +12345678 +1234567890123456 ++1 222-333-444)",
    "é😀 mail: z@w.org 😀 10.0.0.1",
    "call 212-555-0199 now, j.doe [at] mail [dot] org, ssn 078-05-1120 or 000-00-0000, iban DE89 3704 0044 0532 0130 00",
    "7" * 30_000 + " " + "a" * 60_000 + "@" + "+1" + "(" * 20_000,
    " ".join(f"u{i}@h{i}.org" for i in range(3000)),
    "",
    None,
]


def luhn(digits):
    total = 0
    for i, ch in enumerate(reversed(digits)):
        v = int(ch) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p[-9:]) <= 255 and len(p.lstrip("0")) < 4 for p in match.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def plain(text):
    # The e-mail pattern is quadratic on a long run of letters; such a run is one local part.
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


@pytest.mark.parametrize("table", ["texts", "documents", "odd", "empty"])
def test_base_spans(request, spark, table, monkeypatch):
    if table == "texts":
        rows = [(i, t if t is None or len(t) < 100_000 else t[:200] + t[29_990:30_400] + t[-300:]) for i, t in enumerate(TEXTS)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    else:
        docs = request.getfixturevalue(table)
    monkeypatch.setattr(catalog, "table", lambda *_: docs)
    expected = Counter()
    for d in pick(docs, "doc_id", "text").collect():
        spans = plain(d.text)
        counts = Counter(k for k, _, _ in spans)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected[d.doc_id, *[counts[k] for k in PATTERNS], hashlib.sha256(joined.encode()).hexdigest(), joined] += 1
    got = Counter()
    for r in catalog.QUERIES["op5_find_private"](spark, "").collect():
        base = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS)
        got[r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, base] += 1
    assert got == expected


def test_further_kinds(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    found = {r.doc_id: [(s.kind, TEXTS[r.doc_id][s.start : s.end]) for s in r.spans] for r in private.find(docs).collect()}
    assert ("local_phone", "212-555-0199") in found[5] and ("spelled_email", "j.doe [at] mail [dot] org") in found[5]
    assert ("national_id", "078-05-1120") in found[5]
    assert len(found[7]) == 3000 and len(found[6]) == 0


def planted(draw, many):
    """Texts with spans of the further kinds, and with look-alikes that are part of something else."""
    word = lambda: "".join(draw.choice("abcdefghijklmnoprstuvw") for _ in range(draw.randrange(2, 9)))
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    texts, personal, other = [], [], []
    for i in range(many):
        true = draw.random() < 0.5
        kind = draw.choice(["local_phone", "national_id", "iban", "spelled_email"])
        span = {
            "local_phone": f"{draw.randrange(2, 10)}{digits(2)}-{digits(3)}-{digits(4)}" if true else f"1{draw.choice('01')}1-111-{draw.choice('01') * 4}",
            "national_id": f"{draw.randrange(100, 600)}-{draw.randrange(10, 99)}-{draw.randrange(1000, 9999)}" if true else f"000-00-{draw.choice('01') * 4}",
            "iban": f"DE{digits(2)} {' '.join(digits(4) for _ in range(4))} {digits(2)}" if true else f"AB11 {' '.join(['1111'] * 3)}",
            "spelled_email": f"{word()} [at] {word()} [dot] org",
        }[kind]
        announce = {"local_phone": "call", "national_id": "ssn", "iban": "iban", "spelled_email": "mail"}[kind]
        before = f"{word()} {announce} " if true else f"{word()} part{digits(1)}x" if kind != "spelled_email" else f"{word()} "
        text = f"{word()} {before}{span} {word()}"
        start = text.index(span)
        (personal if true else other).append((i, kind, start, start + len(span)))
        texts.append((i, text))
    return texts, personal, other


def test_precision_and_recall_of_further_kinds(spark):
    texts, personal, other = planted(random.Random(4), 1500)
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    found = {(r.doc_id, s.kind, s.start, s.end) for r in private.find(docs).collect() for s in r.spans if s.kind in private.MORE}
    hits = found & set(personal)
    assert len(hits) >= 0.95 * len(personal)
    # Spelled addresses are personal wherever they stand.
    wrong = [f for f in found & set(other) if f[1] != "spelled_email"]
    assert len(wrong) <= 0.05 * len(hits)


def test_classifier_sees_more_than_the_votes(spark):
    """With no vote on it, the word before a span tells."""
    counts = {}
    for before, good in ((3, True), (7, False)):
        votes = (1, 1, 1, 1) if good else (-1, 0, -1, -1)
        counts["local_phone", *votes, 0, before, 0, 4] = 900
        counts["local_phone", 1, 0, 1, 0, 0, before, 0, 4] = 10
    weights = private.classifier(counts)
    odds = {before: sum(w * v for w, v in zip(weights, private._features(("local_phone", 1, 0, 1, 0, 0, before, 0, 4)))) for before in (3, 7)}
    assert odds[3] > odds[7] + 1


def test_very_long_text(spark):
    """Whole texts of a million characters with spans at both ends and between."""
    parts = ["x@y.zz", "lorem ipsum " * 30_000, "10.0.0.1 ", "dolor " * 60_000, "+49 30 1234567", " sit amet" * 40_000, " 4111 1111 1111 1111"]
    text = "".join(parts)
    assert len(text) > 1_000_000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = private.find(docs).first()
    assert [(s.kind, s.start, s.end) for s in row.base] == plain(text)


def test_reliabilities_trust_the_better_labeler():
    counts = {("card", 1, 1, 1, 1, 1): 500, ("card", -1, 0, -1, -1, 1): 500, ("card", 1, 0, 1, -1, 1): 60, ("card", -1, 1, -1, 1, 1): 40}
    post, table = private.reliabilities(counts)
    assert post["card", 1, 1, 1, 1, 1] > 0.99 and post["card", -1, 0, -1, -1, 1] < 0.01
    assert table["shape", 1][1] > table["shape", 0][1]


def test_redacted(spark, odd):
    texts = ["a x@y.zz b +1 (487) 555-7209.", "1.2.3.4", None, "clean"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("text", "doc_id", "'s' as spans", "1 as base")
    rows = private.redacted(docs)
    assert rows.columns == docs.columns
    assert {r.doc_id: r.text for r in rows.collect()} == {0: "a [email] b [phone].", 1: "[ip]", 2: None, 3: "clean"}
    assert private.redacted(odd).count() == odd.count()
