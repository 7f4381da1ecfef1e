"""Feature choice, imputation, scaling and encoding with reusable state.

The categories of text columns are a stored table (feature, value, code) that rows are joined to; neither the driver nor a
plan ever holds them. A row carries one code per text column, or is made a sparse vector with a place per category.
"""

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tenderlens.functions import scalars as S
from tenderlens.functions.quantiles import exact_quantiles
from tenderlens.schema import (
    CLUSTER_SKIPPED_FRAGMENTS,
    MODEL_SKIPPED_FRAGMENTS,
    SCORING_OUTPUTS,
    has_fragment,
)
from tenderlens.session import materialise, scratch_path

NUMERIC = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType)
CATEGORICAL = (T.StringType, T.BooleanType)
_UNSEEN = "\x00"
CATEGORIES = "feature string, value string, code bigint"
# Categories of a column that are sent to all tasks; more are joined by a shuffle.
MOST_BROADCAST = 100_000


def _skipped(name: str, fragments, whole_word: bool) -> bool:
    if whole_word:
        words = name.lower().replace("-", " ").replace("_", " ").split()
        return any(fragment in words or fragment == name.lower() for fragment in fragments)
    return has_fragment(name, fragments)


def model_features(df: DataFrame, whole_word: bool = False) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names.

    Names that contain an id, code or date fragment are left out, also inside a word;
    ``whole_word`` limits this to whole words. Columns that scoring adds never count.
    """
    fields = [
        f
        for f in df.schema
        if f.name not in SCORING_OUTPUTS and not _skipped(f.name, MODEL_SKIPPED_FRAGMENTS, whole_word)
    ]
    numeric = [f.name for f in fields if isinstance(f.dataType, NUMERIC)]
    categorical = [f.name for f in fields if isinstance(f.dataType, CATEGORICAL)]
    return numeric, categorical


def cluster_features(df: DataFrame, whole_word: bool = False) -> list[str]:
    """Numeric feature names of the cluster run."""
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, NUMERIC)
        and f.name not in SCORING_OUTPUTS
        and not _skipped(f.name, CLUSTER_SKIPPED_FRAGMENTS, whole_word)
    ]


@dataclass
class FeatureState:
    """What fitting learnt: per numeric column fill, mean and population deviation; per text column fill and number
    of categories, which are numbered from 0 in the order of their values in the table at ``categories``."""

    inputs: list[str] = field(default_factory=list)
    numeric: dict[str, tuple[float, float, float]] = field(default_factory=dict)
    categorical: dict[str, tuple[str, int]] = field(default_factory=dict)
    categories: str | None = None

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(many for _, many in self.categorical.values())

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, data: dict) -> "FeatureState":
        numeric = {name: tuple(stats) for name, stats in data["numeric"].items()}
        categorical = {name: tuple(known) for name, known in data["categorical"].items()}
        return cls(list(data["inputs"]), numeric, categorical, data["categories"])


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    return exact_quantiles(df, {c: (S.col(c), 0.5) for c in columns}) if columns else {}


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, count) over the non-null values of all columns, in one shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), S.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).filter("value is not null").groupBy("feature", "value").agg(F.count("*").alias("count"))


def _most_frequent(counts: DataFrame) -> Column:
    return F.min(F.struct((-F.col("count")).alias("rank"), "value"))["value"]


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """The most frequent value of each column, the smallest on a tie."""
    counts = category_counts(df, columns)
    return counts.groupBy("feature").agg(_most_frequent(counts).alias("value"))


def numbered_categories(counts: DataFrame) -> DataFrame:
    """(feature, value, code): the values of each feature numbered from 0 in their order, by ranges of values."""
    keys = ["feature", "value"]
    placed = counts.select(keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id() % (1 << 33)
    placed = materialise(placed.withColumns({"part": F.spark_partition_id(), "place": place}), "placed")
    # One row per range.
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))
    starts = sizes.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("start"))
    known = placed.join(F.broadcast(starts), "part").withColumn("at", F.col("start") + F.col("place"))
    # One row per feature.
    firsts = known.groupBy("feature").agg(F.min("at").alias("first"))
    return known.join(F.broadcast(firsts), "feature").select(*keys, (F.col("at") - F.col("first")).alias("code"))


def scale_statistics(df: DataFrame, fills: dict[str, float]) -> dict[str, tuple[float, float, float]]:
    """Fill, mean and population deviation of each column after filling, in one pass."""
    if not fills:
        return {}
    exprs = []
    for i, (name, fill) in enumerate(fills.items()):
        value = F.coalesce(S.col(name).cast("double"), F.lit(float(fill)))
        exprs += [F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    row = df.agg(*exprs).first()
    return {name: (float(fill), row[f"m{i}"], row[f"s{i}"]) for i, (name, fill) in enumerate(fills.items())}


def fit(df: DataFrame, numeric: list[str], categorical: list[str]) -> FeatureState:
    """Learn medians, scales, fills and categories; columns without values leave the matrix."""
    fills = {c: m for c, m in medians(df, numeric).items() if m is not None}
    state = FeatureState(inputs=[*numeric, *categorical], numeric=scale_statistics(df, fills))
    if categorical:
        counts = materialise(category_counts(df, categorical), "category_counts")
        # One row per column.
        known = {r.feature: (r.fill, r.many) for r in counts.groupBy("feature").agg(_most_frequent(counts).alias("fill"), F.count("*").alias("many")).collect()}
        state.categorical = {c: known[c] for c in categorical if c in known}
        state.categories = scratch_path(df.sparkSession, "categories")
        numbered_categories(counts).write.partitionBy("feature").parquet(state.categories)
    return state


def fit_zero_filled(df: DataFrame, numeric: list[str]) -> FeatureState:
    """State of the cluster run: nulls count as 0, values are standardised."""
    return FeatureState(inputs=list(numeric), numeric=scale_statistics(df, {c: 0.0 for c in numeric}))


def standardised(value: Column, mean: float, deviation: float) -> Column:
    """(value - mean) / deviation, 0 for a constant column."""
    if not deviation:
        return F.lit(0.0)
    return (value - F.lit(mean)) / F.lit(deviation)


def align(df: DataFrame, state: FeatureState) -> DataFrame:
    """``df`` with every trained column: absent numbers as 0, absent texts as a value never seen."""
    absent = {c: F.lit(0.0) for c in state.numeric if c not in df.columns}
    absent |= {c: F.lit(_UNSEEN) for c in state.categorical if c not in df.columns}
    return df.withColumns(absent) if absent else df


def _numbers(state: FeatureState) -> list[Column]:
    return [
        standardised(F.coalesce(S.col(name).cast("double"), F.lit(fill)), mean, deviation)
        for name, (fill, mean, deviation) in state.numeric.items()
    ]


def _coded(df: DataFrame, state: FeatureState) -> tuple[DataFrame, list[Column]]:
    """Rows, in order, as a struct ``_row`` with the code of each text column, null for values never seen."""
    places = {f"c{i}": S.col(name) for i, name in enumerate(df.columns)}
    aligned = align(df, state)
    values = {f"_v{i}": F.coalesce(S.col(name).cast("string"), F.lit(fill)) for i, (name, (fill, _)) in enumerate(state.categorical.items())}
    own = F.struct(*[value.alias(name) for name, value in places.items()]).alias("_row")
    rows = aligned.select(own, F.array(*_numbers(state)).cast("array<double>").alias("_numbers"), *[v.alias(n) for n, v in values.items()])
    codes = []
    for i, (name, (_, many)) in enumerate(state.categorical.items()):
        table = df.sparkSession.read.schema(CATEGORIES).parquet(state.categories).filter(F.col("feature") == name)
        table = table.select(F.col("value").alias(f"_v{i}"), F.col("code").alias(f"_code{i}"))
        rows = rows.join(F.broadcast(table) if many <= MOST_BROADCAST else table, f"_v{i}", "left")
        codes.append(F.col(f"_code{i}"))
    return rows, codes


def _plain(rows: DataFrame, df: DataFrame, added: Column) -> DataFrame:
    flat = rows.select("_row", added.alias("_added")).select("_row.*", "_added")
    return flat.toDF(*df.columns, "features")


def with_codes(df: DataFrame, state: FeatureState) -> DataFrame:
    """``df`` and ``features``: the numeric block, then the code of each text column, -1 for a value never seen."""
    rows, codes = _coded(df, state)
    return _plain(rows, df, F.concat("_numbers", F.array(*[F.coalesce(code, F.lit(-1)) for code in codes]).cast("array<double>")))


def with_features(df: DataFrame, state: FeatureState) -> DataFrame:
    """``df`` and its ``features`` array: the numeric block, then one 0/1 place per category. For few categories."""
    rows, codes = _coded(df, state)
    blocks = [_one_hot(F.coalesce(code + 1, F.lit(0)), many) for code, (_, many) in zip(codes, state.categorical.values())]
    return _plain(rows, df, F.concat("_numbers", *blocks))


def _one_hot(place: Column, width: int) -> Column:
    """Zeros with a 1 at ``place``; all zeros for place 0."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n.cast("int"))
    hot = F.concat(zeros(place - 1), F.array(F.lit(1.0)), zeros(width - place))
    return F.when(place > 0, hot).otherwise(zeros(F.lit(width)))


def with_vectors(df: DataFrame, state: FeatureState) -> DataFrame:
    """``df`` and ``features`` as a sparse vector, laid out like the array of :func:`with_features`.

    A row holds its numbers and one entry per text column, however many categories there are.
    """
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from pyspark.ml.functions import array_to_vector

    rows, codes = _coded(df, state)
    sizes = [many for _, many in state.categorical.values()]
    rows = rows.select("_row", array_to_vector("_numbers").alias("_n"), *[F.coalesce(c, F.lit(many)).cast("double").alias(f"_c{i}") for i, (c, many) in enumerate(zip(codes, sizes))])
    names, hot = [f"_c{i}" for i in range(len(sizes))], [f"_h{i}" for i in range(len(sizes))]
    if names:
        # The encoder learns the number of categories from one row; the place behind them, for unseen values, is dropped.
        ends = df.sparkSession.createDataFrame([tuple(float(many) for many in sizes)], ", ".join(f"{n} double" for n in names))
        rows = OneHotEncoder(inputCols=names, outputCols=hot, dropLast=True).fit(ends).transform(rows)
    rows = VectorAssembler(inputCols=["_n", *hot], outputCol="_v").transform(rows)
    return _plain(rows, df, F.col("_v"))


def encode_many(df: DataFrame, column: str, output: str) -> DataFrame:
    """Sparse one-hot vector for a column of many categories; unseen values are all zeros."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    indexer = StringIndexer(inputCol=column, outputCol="_index", handleInvalid="keep", stringOrderType="alphabetAsc")
    indexed = indexer.fit(df).transform(df)
    encoder = OneHotEncoder(inputCol="_index", outputCol=output, dropLast=True)
    return encoder.fit(indexed).transform(indexed).drop("_index")
