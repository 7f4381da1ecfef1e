"""Mixing sources to target weights by hash thresholds.

A source's target is whole passes over its documents and a remainder. The remainder goes to
the documents whose hash lies below a threshold, so a larger budget takes the documents of a
smaller one and more. The threshold comes from histograms of words by source and hash bucket:
the bucket where the budget ends is cut into finer buckets, and only its documents are looked
at again, until one hash is left there. Nothing is sorted and no document leaves its row.

Null texts have size 0 and a null source is one source, after all others. The hash covers id and
text, so rows with null or repeated ids are told apart. Where the budget ends among rows equal in both, which are all
alike, as many of them are taken as come nearest to it. A
source without words has target 0. An empty table gives no rows; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderlens.llm.common import WORD, at, beside, pick, text_or_empty, unpacked
from tenderlens.session import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
SEED = 17
BITS = 10  # of the hash that one histogram tells apart
LEVELS = 6  # 60 of 64 bits; documents that agree in those are told apart by number


def _hash(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id.cast("bigint"), text_or_empty(text))


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, hash), written once: the texts are read here only."""
    slim = pick(docs, "doc_id", "source", "text")
    size = F.regexp_count(text_or_empty(F.col("text")), F.lit(WORD)).cast("bigint")
    hash_ = _hash(F.col("doc_id"), F.col("text"), seed)
    return materialise(slim.select("doc_id", "source", size.alias("size"), hash_.alias("hash")), "sizes")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place by code point, null last: places within range parts, shifted by the parts before."""
    order = F.col("source").asc_nulls_last()
    parts = materialise(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    many = parts.groupBy("part").agg(F.count("*").alias("many"))
    # One row per range part.
    before = many.select("part", (F.sum("many").over(Window.orderBy("part")) - F.col("many")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return parts.withColumn("place", place).join(before, "part").withColumn("place", F.col("place") + F.col("before")).drop("part", "before")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(source, source_size, target): the shared amount by weight, the excess over ``passes`` sizes reshared."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = materialise(_ranked(totals).select("source", "source_size", weight.alias("weight")), "ranked")
    room = F.col("source_size") * float(passes)
    level, full = 0.0, -1
    whole = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        open_ = room > F.col("weight") * level
        row = ranked.agg(
            F.count_if(~open_).alias("full"), F.sum(F.when(~open_, room)).alias("spent"), F.sum(F.when(open_, F.col("weight"))).alias("weight")
        ).first()
        if row.full == full or not row.weight:
            break
        full = row.full
        level = (whole - (row.spent or 0.0)) / row.weight
    return ranked.select("source", "source_size", F.least(room, F.col("weight") * level).alias("target"))


def _bucket(hash_: Column, level: int) -> Column:
    return F.shiftrightunsigned(hash_, 64 - BITS * (level + 1)).bitwiseAND((1 << BITS) - 1)


def thresholds(sized: DataFrame, budgets: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(source, .., prefix): documents whose top hash bits lie below ``prefix`` add up to ``budget``, as nearly as whole ones can.

    ``budgets`` has (source, budget) and other columns. Each level sums words by bucket
    within the bucket where the budget ends; a source whose budget is met exactly, or
    whose last bucket holds one hash, stays as it is. Of several documents at the last level's hash ``edge``, any
    ``some`` are taken besides.
    """
    open_ = budgets.withColumns({"prefix": F.lit(0).cast("bigint"), "left": F.col("budget").cast("double")})
    for level in range(levels):
        ahead = open_.select(F.col("source").alias("own"), "prefix")
        met = sized.withColumn("top", F.shiftrightunsigned("hash", 64 - BITS * level) if level else F.lit(0).cast("bigint"))
        met = met.join(ahead, F.col("source").eqNullSafe(F.col("own")) & (F.col("top") == F.col("prefix")), "left_semi")
        sums = met.groupBy("source", _bucket(F.col("hash"), level).alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        sums = sums.withColumn("upto", upto).withColumn("below", upto - F.col("words"))
        joined = open_.join(sums.withColumnRenamed("source", "own"), F.col("source").eqNullSafe(F.col("own")), "left")
        # The bucket where the budget ends; past the last one, all are below.
        ends = F.when(F.col("upto") > F.col("left"), F.struct("bucket", "below", "words", "docs"))
        found = joined.groupBy(*open_.columns).agg(F.min(ends).alias("at"), F.coalesce(F.max("upto"), F.lit(0)).alias("all"))
        bucket, left = F.coalesce("at.bucket", F.lit(1 << BITS)), F.col("left") - F.coalesce("at.below", "all")
        found = materialise(found.withColumns({"prefix": F.shiftleft("prefix", BITS) + bucket, "left": left}), "thresholds")
        if level == levels - 1 or found.filter("at.docs > 1").isEmpty():
            break
        open_ = found.drop("at", "all")
    # What is left of the bucket goes with the budget where that brings it nearer.
    nearer = F.when(F.col("at.words") - F.col("left") < F.col("left"), 1).otherwise(0)
    if level < levels - 1:
        several = F.lit(False)
    else:
        several = F.coalesce(F.col("at.docs") > 1, F.lit(False))
    each = F.col("at.words") / F.col("at.docs")
    some = F.when(several & (each > 0), F.ceil(F.col("left") / each - 0.5)).otherwise(0).cast("bigint")
    edge = F.when(several, F.col("prefix")).otherwise(-1)
    ends = F.shiftleft(F.col("prefix") + F.when(several, 0).otherwise(nearer), BITS * (levels - 1 - level))
    return found.withColumns({"edge": edge, "some": some, "prefix": ends}).drop("at", "all")


def planned(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES, levels: int = LEVELS) -> DataFrame:
    """(own, source_size, target, whole, prefix, ..) per source: whole passes, and the threshold of one more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = targets(sized, weights, share, passes).withColumn("whole", whole)
    aims = materialise(aims.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "aims")
    return thresholds(sized, aims, levels).withColumnRenamed("source", "own")


def _top(hash_: Column, levels: int) -> Column:
    return F.shiftrightunsigned(hash_, 64 - BITS * levels)


def times(hash_: Column, nth: Column, passes: int = PASSES, levels: int = LEVELS) -> Column:
    """How often a row is taken; ``nth`` numbers the rows at a source's edge from 0."""
    more = (_top(hash_, levels) < F.col("prefix")) | ((_top(hash_, levels) == F.col("edge")) & (nth < F.col("some")))
    return (F.col("whole") + F.when(more & (F.col("whole") < passes), 1).otherwise(0)).cast("bigint")


def _numbered(rows: DataFrame, plan: DataFrame, levels: int) -> DataFrame:
    """``rows`` (source, hash, ..) with the plan of their source, and ``nth`` for those at an edge.

    Rows at an edge are written, numbered within their part and shifted by the parts before, so that not even
    a third of all rows being alike brings them to one task.
    """
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("own")))
    if plan.filter("some > 0").isEmpty():
        return joined.withColumn("nth", F.lit(0).cast("bigint"))
    at_edge = (_top(F.col("hash"), levels) == F.col("edge")) & (F.col("some") > 0)
    placed = materialise(joined.filter(at_edge).withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "edges")
    # One row per part and source.
    sizes = placed.groupBy("source", "part").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("source").orderBy("part")) - F.col("rows")
    sizes = materialise(sizes.select(F.col("source").alias("its"), F.col("part").alias("its_part"), before.alias("before")), "parts")
    nth = F.row_number().over(Window.partitionBy("source", "part").orderBy("place")) - 1 + F.col("before")
    numbered = placed.join(sizes, F.col("source").eqNullSafe(F.col("its")) & (F.col("part") == F.col("its_part")))
    numbered = numbered.withColumn("nth", nth.cast("bigint")).drop("part", "place", "its", "its_part", "before")
    return joined.filter(~at_edge).withColumn("nth", F.lit(0).cast("bigint")).unionByName(numbered)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES, seed: int = SEED, levels: int = LEVELS):
    """(doc_id, source, size, source_size, target, times, taken); ``times`` is how often the mix repeats the document."""
    sized = sizes(docs, seed)
    plan = planned(sized, weights, share, passes, levels)
    joined = _numbered(sized, plan, levels).withColumn("times", times(F.col("hash"), F.col("nth"), passes, levels))
    return joined.select("doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES, seed: int = SEED, levels: int = LEVELS):
    """``docs`` with every row as often as the mix takes it."""
    plan = planned(sizes(docs, seed), weights, share, passes, levels).select("own", "whole", "prefix", "edge", "some")
    rows = beside(docs, source=at(docs, "source"), hash=_hash(at(docs, "doc_id"), at(docs, "text"), seed))
    again = F.explode(F.array_repeat(F.lit(1), times(F.col("hash"), F.col("nth"), passes, levels).cast("int")))
    return unpacked(_numbered(rows, plan, levels).select("row", again), docs)
