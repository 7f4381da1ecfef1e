"""Quality rules as a ledger of bits.

Every rule is evaluated once and leaves a bit (set: failed) beside the measurements. A policy is a
named mask of rules; applying it, or another version of it, reads bits only. Ablations come from
the histogram of bit patterns, which has at most 2^rules rows.

Null texts have no words and fail the length rule. Rows are judged alone, so repeated or null ids
change nothing. An empty table gives no rows; other columns are ignored.

Three-word windows are compared by a 64-bit hash.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tenderlens.llm.common import pick, text_or_empty, words

SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"


def measurements(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    slim = pick(docs, "doc_id", "text").withColumn("text", text_or_empty(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    first = slim.select(
        "doc_id",
        F.length("text").alias("chars"),
        F.length(F.translate("text", BLANK, "")).alias("word_chars"),
        F.length(F.translate("text", SYMBOLS, "")).alias("plain_chars"),
        lines.alias("lines"),
        words(F.col("text")).alias("words"),
    )
    windows = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
        lambda word, i: F.struct(F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2)).alias("hash"), i.alias("i")),
    )
    second = first.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.col("word_chars").cast("bigint").alias("word_chars"),
        (F.col("chars") - F.col("plain_chars")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.sort_array(windows).alias("w"),
    )
    # Equal windows are neighbours now; what is left are the places of those found again.
    again = F.filter("w", lambda x, i: (x["hash"] == F.get("w", i - 1)["hash"]) | (x["hash"] == F.get("w", i + 1)["hash"]))
    third = second.withColumn("w", F.sort_array(F.transform(again, lambda x: x["i"])))
    # Each place adds the words up to the next one, three at most.
    covered = F.aggregate(
        F.transform("w", lambda i, k: F.least(F.coalesce(F.get("w", k + 1) - i, F.lit(3)), F.lit(3))), F.lit(0), lambda total, more: total + more
    )
    return third.select(*third.columns[:-1], covered.cast("bigint").alias("n_repeat_words"))


def rules() -> dict[str, Column]:
    """True where a document fails; a rule's place is its bit."""
    n = F.col("n_words")
    return {
        "few_words": n < 50,
        "repeated_windows": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "short_words": F.col("word_chars") < 2 * n,
        "long_words": F.col("word_chars") > 20 * n,
        "repeated_lines": 3 * F.col("n_dup_lines") > F.greatest(n / 10, F.lit(6)),
    }


# A policy never changes once it has been used; a new version is a new entry.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols"),
    "v2": ("few_words", "repeated_windows", "symbols", "short_words", "long_words", "repeated_lines"),
}


def mask(policy: str) -> int:
    names = list(rules())
    return sum(1 << names.index(name) for name in POLICIES[policy])


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``failure_bits``."""
    bits = [F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(rules().values())]
    return measurements(docs).withColumn("failure_bits", sum(bits[1:], bits[0]).cast("bigint"))


def kept(policy: str) -> Column:
    return F.col("failure_bits").bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(book: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` and the policy's name."""
    base_failed = ~kept("base")
    return book.withColumns({"base_failed": base_failed, "kept": ~base_failed & kept(policy), "policy": F.lit(policy)})


def ablation(book: DataFrame, *policies: str) -> DataFrame:
    """(policy, rule, failed, failed_alone, n_docs, kept_without, words_without) per policy and rule.

    ``failed_alone``: documents this rule alone rejects; ``kept_without``, ``words_without``: what
    the policy keeps when it leaves the rule out.
    """
    patterns = book.groupBy("failure_bits").agg(F.count("*").alias("docs"), F.sum("n_words").alias("words"))
    names = list(rules())
    asked = [
        F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(p)).alias("mask"), F.lit(1 << names.index(r)).alias("bit"))
        for p in policies or POLICIES
        for r in POLICIES[p]
    ]
    each = patterns.select("*", F.inline(F.array(*asked)))
    fails, bit = F.col("failure_bits").bitwiseAND(F.col("mask")), F.col("bit")
    rest = fails.bitwiseAND(F.bitwise_not(bit))
    add = lambda when, what: F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0))
    return each.groupBy("policy", "rule").agg(
        add(fails.bitwiseAND(bit) != 0, "docs").alias("failed"),
        add(fails == bit, "docs").alias("failed_alone"),
        F.sum("docs").alias("n_docs"),
        add(rest == 0, "docs").alias("kept_without"),
        add(rest == 0, "words").alias("words_without"),
    )
