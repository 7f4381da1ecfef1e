"""Personal data by weak supervision.

Patterns propose spans. Labelers vote on each: the shape of the kind, a gazetteer of words that
announce personal data, the characters around it, and the variety of its digits. Votes may
contradict and abstain. Expectation-maximisation over the histogram of votes estimates
how far each labeler can be trusted and how likely each combination is personal; these figures train
the final span classifier, a logistic model that sees more than the labelers do: the words before and
behind the span, by hash, and the characters it is made of. It decides on spans of the
further kinds. Spans of the base kinds follow exact rules and always stay.

The histogram has at most a row for each combination of votes, sizes, word buckets and forms, whatever the corpus;
all else are column expressions.

Null texts are empty and have no spans. Rows are judged alone, so null or repeated ids change
nothing. An empty table gives no rows; other columns are ignored.
"""

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tenderlens.llm.common import at, beside, let, pick, text_or_empty, unpacked
from tenderlens.session import materialise

# Possessive loops and look-behinds find the same leftmost matches as plain ones, in linear time.
BASE = {
    "email": (r"@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9][\x20-]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
MORE = {
    "spelled_email": (
        r"[\[(](?i:at)[\])]",
        r"[A-Za-z0-9._%+-]{1,64} ?[\[(](?i:at)[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(](?i:dot)[\])] ?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63}){1,8}",
    ),
    "local_phone": (r"[0-9]{3}[.-][0-9]{4}", r"(?<![0-9+])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[.-][0-9]{4}(?![0-9])"),
    "national_id": (r"[0-9]-[0-9]{2}-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": (r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
}
KINDS = [*BASE, *MORE]
GAZETTEER = (
    "account appel call cell contact contacto courriel e-mail email fax iban id konto kontakt llama mail mobil mobile móvil "
    "number numéro nummer phone reach social ssn tel telefon telefono teléfono téléphone whatsapp write"
).split()
LABELERS = ("shape", "gazetteer", "context", "variety")
LENGTHS = (12, 16, 24)
NEAR = 40  # characters on either side in which the nearest word is looked for
BEFORE, BEHIND = 16, 8  # buckets of that word; 0 is none
FORMS = (r"\p{L}", " ", "[.-]", r"[()\[\]]")  # bits: whether the span has such characters
FEATURES = ("size", "before", "behind", "form")
ROUNDS = 25
STEPS = 300
_BLOCK = 64

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits from the right, every second one doubled, is a multiple of ten."""

    def value(ch: Column, i: Column) -> Column:
        v = F.ascii(ch) - 48
        return F.when(ch == "", 0).when(i % 2 == 0, v).otherwise(2 * v - F.when(v > 4, 9).otherwise(0))

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda s, v: s + v)
    return total % 10 == 0


def _shape(kind: str, match: Column) -> Column:
    """Whether the match obeys the rules of its kind."""
    count = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")
    if kind == "card":
        return F.when(count.between(13, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return count.between(9, 15)
    if kind == "local_phone":
        return match.rlike(r"\A\(?[2-9]")
    if kind == "national_id":
        return ~match.rlike(r"\A(?:000|666|9)|-00-|-0000\z")
    if kind == "iban":
        return F.length(F.translate(match, " ", "")).between(15, 34)
    return F.lit(True)


def _vote(when: Column) -> Column:
    return F.when(when, 1).otherwise(-1)


def _word_bucket(text: Column, pattern: str, buckets: int) -> Column:
    word = F.regexp_extract(text, pattern, 1)
    return F.when(word == "", 0).otherwise(F.pmod(F.xxhash64(F.lower(word)), F.lit(buckets)).cast("int") + 1)


def _labels(kind: str, match: Column, left: Column, right: Column) -> Column:
    announced = F.lower(left).rlike(rf"(?:^|[^\p{{L}}])(?:{'|'.join(GAZETTEER)})[^\p{{L}}]*$")
    alone = ~left.rlike(r"[\p{L}0-9_]$") & ~right.rlike(r"^[\p{L}0-9_]")
    digits = _digits(match)
    varied = F.size(F.array_distinct(F.split(digits, ""))) >= 4
    return F.struct(
        _vote(_shape(kind, match)).alias("shape"),
        F.when(announced, 1).otherwise(0).alias("gazetteer"),
        _vote(alone).alias("context"),
        F.when(F.length(digits) >= 6, _vote(varied)).otherwise(0).alias("variety"),
        sum((F.when(F.length(match) > n, 1).otherwise(0) for n in LENGTHS), F.lit(0)).alias("size"),
        _word_bucket(left, r"(\p{L}+)[^\p{L}]*$", BEFORE).alias("before"),
        _word_bucket(right, r"^[^\p{L}]*(\p{L}+)", BEHIND).alias("behind"),
        sum((F.when(match.rlike(form), 1 << i).otherwise(0) for i, form in enumerate(FORMS)), F.lit(0)).alias("form"),
    )


def _candidates(rows: DataFrame) -> DataFrame:
    """``rows`` has ``text``; adds ``spans``: every match with its place, kind and labels, by kind and start.

    A match starts after all that was split off before it, so starts are sums of lengths,
    taken by blocks to keep texts of many matches cheap.
    """
    others = rows.columns
    found = {}
    for kind, (hint, pattern) in {**BASE, **MORE}.items():
        there = F.col("text").rlike(hint)
        found[f"m_{kind}"] = F.when(there, F.regexp_extract_all("text", F.lit(pattern), 0)).otherwise(F.array().cast("array<string>"))
        found[f"p_{kind}"] = F.when(there, F.split("text", pattern, -1)).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns(found)
    add = lambda s, v: s + v
    zero = F.lit(0)

    def lengths(kind):
        return F.transform(f"m_{kind}", lambda m, i: F.length(m) + F.length(F.get(f"p_{kind}", i)))

    def blocks(kind):
        places = F.sequence(zero, F.floor(F.size(f"l_{kind}") / _BLOCK).cast("int"))
        return F.transform(places, lambda b: F.aggregate(F.slice(f"l_{kind}", b * _BLOCK + 1, _BLOCK), zero, add))

    rows = rows.withColumns({f"l_{kind}": lengths(kind) for kind in KINDS})

    def spans(kind, sums):
        def one(match: Column, i: Column) -> Column:
            whole = F.floor(i / _BLOCK).cast("int")
            before = F.aggregate(F.slice(sums, 1, whole), zero, add)
            rest = F.aggregate(F.slice(f"l_{kind}", whole * _BLOCK + 1, i % _BLOCK), zero, add)
            piece = F.get(f"p_{kind}", i)
            start = before + rest + F.length(piece)
            left, right = F.right(piece, F.lit(NEAR)), F.substring(F.get(f"p_{kind}", i + 1), 1, NEAR)
            return F.struct(
                F.lit(kind).alias("kind"),
                start.cast("bigint").alias("start"),
                (start + F.length(match)).cast("bigint").alias("end"),
                _labels(kind, match, left, right).alias("labels"),
            )

        return F.transform(f"m_{kind}", one)

    def found_spans(kind):
        return let(blocks(kind), lambda sums: spans(kind, sums))

    return rows.select(*others, F.concat(*[found_spans(kind) for kind in KINDS]).alias("spans"))


def _is_base(span: Column) -> Column:
    return span["kind"].isin(*BASE)


def detect(rows: DataFrame) -> DataFrame:
    """``rows`` has ``text``; adds ``base`` spans and ``spans``, all candidates with their votes.

    A candidate of a further kind that meets a base span is left to that.
    """
    others = rows.columns
    rows = _candidates(rows)
    base = F.filter("spans", lambda s: _is_base(s) & (s["labels"]["shape"] == 1))

    def kept(base):
        meets = lambda s: F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.filter("spans", lambda s: _is_base(s) | ~meets(s))

    return rows.select(*others, base.alias("base"), let(base, kept).alias("spans"))


def patterns(detected: DataFrame) -> dict[tuple, int]:
    """Histogram of (kind, votes, features) over all candidates: at most kinds x 3^labelers x sizes x buckets x forms rows."""
    # The plain explode would have a filter inferred that works the spans out once more.
    each = detected.select(F.explode_outer("spans").alias("s")).select("s.kind", "s.labels.*").filter("kind is not null")
    rows = each.groupBy("kind", *LABELERS, *FEATURES).agg(F.count("*").alias("n")).collect()
    return {tuple(row[:-1]): row.n for row in rows}


def reliabilities(counts: dict[tuple, int], rounds: int = ROUNDS):
    """Posterior of each (kind, votes, ..), and each labeler's chances of its votes for personal and other spans."""
    post = {key: 1 / (1 + math.exp(-1.5 * sum(key[1 : 1 + len(LABELERS)]))) for key in counts}
    table = {}
    for _ in range(rounds):
        prior, table = {}, {}
        for kind in {key[0] for key in counts}:
            own = [key for key in counts if key[0] == kind]
            prior[kind] = (1 + sum(counts[k] * post[k] for k in own)) / (2 + sum(counts[k] for k in own))
        for j, name in enumerate(LABELERS):
            for side in (0, 1):
                mass = dict.fromkeys((-1, 0, 1), 1.0)
                for key, n in counts.items():
                    mass[key[1 + j]] += n * (post[key] if side else 1 - post[key])
                whole = sum(mass.values())
                table[name, side] = {vote: m / whole for vote, m in mass.items()}
        for key in counts:
            odds = math.log(prior[key[0]] / (1 - prior[key[0]]))
            for j, name in enumerate(LABELERS):
                odds += math.log(table[name, 1][key[1 + j]] / table[name, 0][key[1 + j]])
            post[key] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post, table


def _features(key: tuple) -> list[float]:
    kind, *votes, size, before, behind, form = key
    buckets = [[float(value == i) for i in range(1, most + 1)] for value, most in ((size, len(LENGTHS)), (before, BEFORE), (behind, BEHIND))]
    return [1.0, *[float(kind == k) for k in KINDS], *map(float, votes), *sum(buckets, []), *[float(form >> i & 1) for i in range(len(FORMS))]]


def classifier(counts: dict[tuple, int], steps: int = STEPS) -> list[float]:
    """Weights of a logistic model fitted to the posteriors; kinds weigh alike however frequent they are."""
    votes: dict[tuple, int] = {}
    for key, n in counts.items():
        votes[key[: 1 + len(LABELERS)]] = votes.get(key[: 1 + len(LABELERS)], 0) + n
    post, _ = reliabilities(votes)
    of_kind = {kind: sum(n for key, n in votes.items() if key[0] == kind) for kind in KINDS}
    keys = sorted(counts)
    x = np.array([_features(key) for key in keys]).reshape(len(keys), len(_features((KINDS[0], *[0] * (len(LABELERS) + len(FEATURES))))))
    y = np.array([post[key[: 1 + len(LABELERS)]] for key in keys])
    share = np.array([counts[key] / of_kind[key[0]] for key in keys])
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30.0, 30.0)))
        weights -= 0.3 * (0.01 * weights + x.T @ (share * (p - y)))
    return weights.tolist()


def _odds(weights: list[float], span: Column) -> Column:
    own, labels = iter(weights), span["labels"]
    odds = F.lit(next(own))
    for kind in KINDS:
        odds += F.when(span["kind"] == kind, F.lit(next(own))).otherwise(0.0)
    for name in LABELERS:
        odds += labels[name] * F.lit(next(own))
    for name, most in (("size", len(LENGTHS)), ("before", BEFORE), ("behind", BEHIND)):
        odds += F.get(F.array(F.lit(0.0), *[F.lit(next(own)) for _ in range(most)]), labels[name])
    for i in range(len(FORMS)):
        odds += F.when(labels["form"].bitwiseAND(1 << i) != 0, F.lit(next(own))).otherwise(0.0)
    return odds


def decided(detected: DataFrame, weights: list[float]) -> DataFrame:
    """``spans`` becomes the base spans and what the classifier adds, by kind as listed and start."""
    more = F.filter("spans", lambda s: ~_is_base(s) & (_odds(weights, s) > 0))
    return detected.withColumn("spans", F.concat("base", more))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) with spans as structs of kind, start, end and labels."""
    slim = pick(docs, "doc_id", "text").select("doc_id", text_or_empty(F.col("text")).alias("text"))
    detected = materialise(detect(slim).select("doc_id", "base", "spans"), "spans")
    return decided(detected, classifier(patterns(detected)))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; null texts stay null."""
    rows = beside(docs)
    rows = rows.withColumn("text", text_or_empty(at(docs, "text")))
    # Written once: spans are counted first and decided on afterwards.
    detected = materialise(detect(rows).drop("text"), "detected")
    found = decided(detected, classifier(patterns(detected))).withColumn("text", text_or_empty(at(docs, "text")))
    ordered = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    found = found.withColumn("spans", ordered)
    empty = F.struct(F.lit(0).cast("bigint").alias("upto"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, s: Column) -> Column:
        before = F.when(s["start"] > done["upto"], F.substring(F.col("text"), done["upto"].cast("int") + 1, (s["start"] - done["upto"]).cast("int"))).otherwise("")
        mark = F.when(s["start"] >= done["upto"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.greatest(done["upto"], s["end"]).alias("upto"), F.concat(done["parts"], F.array(before, mark)).alias("parts"))

    found = found.withColumn("done", F.aggregate("spans", empty, step))
    rest = F.substring(F.col("text"), F.col("done.upto").cast("int") + 1, F.length("text"))
    text = F.when(F.size("spans") == 0, at(docs, "text")).otherwise(F.concat(F.array_join("done.parts", ""), rest))
    place = docs.columns.index("text")
    return unpacked(found.select(F.col("row").withField(f"c{place}", text).alias("row")), docs)
