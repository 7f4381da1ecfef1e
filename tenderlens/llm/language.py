"""Language identification: the family first, then pairs of languages within it.

Texts are vectors of hashed character n-grams, of length one. Families are found from the training
texts: languages with the most similar mean vectors are joined until about the square root of
their number is left. A linear support vector machine per family picks the family; within it, one
machine for each two languages votes. The machines are fitted on a bounded sample of ``SAMPLE``
distinct labelled texts, evenly over the languages and chosen by hash; whole texts are used throughout.

Null texts and texts without a letter are ``und`` with score 0, and so is every text where no
language could be learned. Null ids count as the empty text for the split and are predicted like
others; each row is predicted alone, repeated or not. An empty table gives no rows. Other columns
are ignored.
"""

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderlens.llm.common import pick, slices
from tenderlens.session import materialise

WIDTH = 4096
SAMPLE = 2000  # labelled texts that are looked at in all, whatever the corpus
ROUNDS = 30
PENALTY = 10.0
SLOPE = 4.0  # of the logistic curve from margin to score
BLOCK = 1 << 20  # characters handled at once


def vector(text: str, width: int = WIDTH) -> np.ndarray | None:
    """Square roots of the counts of hashed 1- to 3-grams, scaled to length one; None without a letter."""
    text = text.lower()
    if not (text.isalpha() or any(map(str.isalpha, text))):
        return None
    counts = np.zeros(width)
    for at in range(0, len(text), BLOCK):
        # Blocks overlap by two characters, so no n-gram is lost; those of the overlap alone are not counted again.
        codes = np.frombuffer(text[max(at - 2, 0) : at + BLOCK].encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        codes = np.where(codes < 65, 32, codes)  # blanks, digits and marks are one
        again = min(at, 2)
        two = codes[:-1] * 31 + codes[1:] * 7919 + 1
        three = two[:-1] * 131 + codes[2:] * 104729
        counts += np.bincount(codes[again:] % width, minlength=width)
        counts += np.bincount((two[max(again - 1, 0) :] * 2654435761 >> 7) % width, minlength=width)
        counts += np.bincount((three * 2654435761 >> 9) % width, minlength=width)
    counts = np.sqrt(counts)
    return counts / np.linalg.norm(counts)


def machine(x: np.ndarray, y: np.ndarray, at: np.ndarray | None = None, rounds: int = ROUNDS, penalty: float = PENALTY) -> np.ndarray:
    """Weights, bias last, of a linear support vector machine: dual coordinate descent on the hinge loss.

    ``at`` names the rows of ``x`` to fit on, ``y`` has their sides. Rows become doubles one at a time: ``x`` is held once.
    """
    at = np.arange(len(x)) if at is None else at
    row = np.ones(x.shape[1] + 1)
    weights, alpha, norms = np.zeros(len(row)), np.zeros(len(at)), np.zeros(len(at))
    for i, place in enumerate(at):
        row[:-1] = x[place]
        norms[i] = (row**2).sum()
    draw = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(len(at)):
            row[:-1] = x[at[i]]
            new = min(max(alpha[i] - (y[i] * weights.dot(row) - 1) / norms[i], 0.0), penalty)
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * row
                moved, alpha[i] = max(moved, abs(new - alpha[i])), new
        if moved < 1e-3:
            break
    return weights


def families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages joined by average similarity of their mean vectors."""
    groups = [[name] for name in sorted(means)]
    shared = np.mean(list(means.values()), axis=0)
    apart = {name: mean - shared for name, mean in means.items()}

    def alike(a, b):
        pairs = [(apart[p], apart[q]) for p in a for q in b]
        return float(np.mean([p.dot(q) / (np.linalg.norm(p) * np.linalg.norm(q) + 1e-12) for p, q in pairs]))

    while len(groups) > math.ceil(math.sqrt(len(means))):
        i, j = max(combinations(range(len(groups)), 2), key=lambda ij: alike(groups[ij[0]], groups[ij[1]]))
        groups[i] = sorted(groups[i] + groups.pop(j))
    return groups


class Discriminator:
    def __init__(self, x: np.ndarray, langs: list[str]):
        langs = np.array(langs, dtype=object)
        self.families = families({name: x[langs == name].astype(float).mean(axis=0) for name in sorted(set(langs))})
        self.of_family, self.of_pair = [], {}
        for family in self.families if len(self.families) > 1 else []:
            self.of_family.append(machine(x, np.where(np.isin(langs, family), 1.0, -1.0)))
        for family in self.families:
            for a, b in combinations(family, 2):
                own = (langs == a) | (langs == b)
                self.of_pair[a, b] = machine(x, np.where(langs[own] == a, 1.0, -1.0), np.flatnonzero(own))

    def predict(self, v: np.ndarray) -> tuple[str, float]:
        v = np.append(v, 1.0)
        family, score = 0, 1.0
        if self.of_family:
            margins = [w.dot(v) for w in self.of_family]
            family = int(np.argmax(margins))
            score = 1 / (1 + math.exp(-SLOPE * margins[family]))
        names = self.families[family]
        votes, least = dict.fromkeys(names, 0), dict.fromkeys(names, 1.0)
        total = dict.fromkeys(names, 0.0)
        for a, b in combinations(names, 2):
            margin = float(self.of_pair[a, b].dot(v))
            votes[a if margin >= 0 else b] += 1
            for name, own in ((a, margin), (b, -margin)):
                total[name] += own
                least[name] = min(least[name], 1 / (1 + math.exp(-SLOPE * own)))
        best = max(names, key=lambda name: (votes[name], total[name]))
        return best, score * least[best]


def learn(docs: DataFrame, training: Column, sample: int = SAMPLE, width: int = WIDTH) -> Discriminator | None:
    """Fit on texts of ``docs`` (doc_id, text, lang) where ``training`` holds and there is a language."""
    known = pick(docs, "doc_id", "text", "lang").filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Drawn by a hash of the text, so many ids or none make no difference; copies count once.
    known = known.withColumn("hash", F.xxhash64(F.lit(5), "text"))
    unit = F.pmod("hash", F.lit(1 << 30)) / (1 << 30)
    # One row per language, each with a text that is drawn in any case.
    texts = known.select("lang", "hash").distinct().groupBy("lang").agg(F.count("*").alias("texts"), F.min("hash").alias("first"))
    texts = materialise(texts, "texts")
    many = texts.count()
    if not many:
        return None
    share = F.least(F.lit(1.0), F.lit(sample / many) / F.col("texts"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(lang, vector(text, width)) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            found = [(lang, v.astype("<f4").tobytes()) for lang, v in found if v is not None]
            arrays = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "v"])

    drawn = known.join(texts, "lang").filter((unit < share) | (F.col("hash") == F.col("first")))
    drawn = drawn.groupBy("lang", "hash").agg(F.min("text").alias("text"))
    # The draw is by hash, so it can pass its mean a little: the bound is twice that in each language.
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    drawn = drawn.withColumn("nth", nth).filter(F.col("nth") <= math.ceil(2 * sample / many))
    rows = drawn.select("lang", "text").mapInArrow(vectors, "lang string, v binary").collect()
    rows.sort(key=lambda row: (row.lang, row.v))
    if not rows:
        return None
    return Discriminator(np.stack([np.frombuffer(row.v, "<f4") for row in rows]), [row.lang for row in rows])


def _judge(model: Discriminator | None, width: int, text: str | None) -> tuple[str, float]:
    v = vector(text, width) if text and model else None
    return ("und", 0.0) if v is None else model.predict(v)


def identify(docs: DataFrame, model: Discriminator | None, width: int = WIDTH) -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs`` (doc_id, text)."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [_judge(model, width, text) for text in batch.column(1).to_pylist()]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), langs, scores], names=["doc_id", "lang_pred", "score"])

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.mapInArrow(predict, "doc_id bigint, lang_pred string, score double")


def accepted(docs: DataFrame, model: Discriminator | None, least: float = 0.0, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of ``least`` or more, all columns kept."""
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [_judge(model, width, text) for text in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([lang != "und" and score >= least for lang, score in found], pa.bool_()))

    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return flat.mapInArrow(keep, flat.schema).toDF(*docs.columns)
