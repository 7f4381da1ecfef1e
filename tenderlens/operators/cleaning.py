"""Cleaning and derivation of notice columns, and the choice of columns for learning."""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tenderlens.functions import scalars as S
from tenderlens.functions.quantiles import exact_quantile
from tenderlens.schema import (
    EUR_RATES,
    LINK_FRAGMENTS,
    ML_BIDDER_COLUMNS,
    ML_ID_FRAGMENTS,
    ML_MONEY_COLUMNS,
    ML_SKIPPED_FRAGMENTS,
    MONEY_TEXT_COLUMNS,
    has_fragment,
)

WIDE_NUMBERS = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType)


def drop_link_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[name for name in df.columns if has_fragment(name, LINK_FRAGMENTS)])


def add_currency(df: DataFrame, source="estimated-value-cur-proc") -> DataFrame:
    """Currency code of each notice; EUR where the source column is absent or not text."""
    is_text = source in df.columns and isinstance(df.schema[source].dataType, T.StringType)
    return df.withColumn("currency", S.currency_code(S.col(source)) if is_text else F.lit("EUR"))


def parse_money(df: DataFrame) -> DataFrame:
    """Money columns to numbers. Columns that are numbers already only lose their sign."""
    parsed = {}
    for name in MONEY_TEXT_COLUMNS:
        if name in df.columns:
            text = isinstance(df.schema[name].dataType, T.StringType)
            parsed[name] = S.money(S.col(name)) if text else F.abs(S.col(name).cast("double"))
    return df.withColumns(parsed) if parsed else df


def add_eur(df: DataFrame) -> DataFrame:
    if "total-value" not in df.columns:
        return df
    return df.withColumn("total-value-eur", S.to_eur(S.col("total-value"), F.col("currency")))


def add_cap_and_flag(df: DataFrame, limit: float | None = None) -> DataFrame:
    """Cap the EUR value at its 95th percentile and flag the values above it."""
    if "total-value-eur" not in df.columns:
        return df
    value = S.col("total-value-eur")
    if limit is None:
        limit = exact_quantile(df, value, 0.95)
    return df.withColumns(
        {
            "total-value-eur-capped": S.capped(value, limit),
            "is_outlier": S.above(value, limit),
            "total-value-eur-log": S.log_value(value),
        }
    )


def add_bidders(df: DataFrame) -> DataFrame:
    if "winner-size" not in df.columns:
        return df
    sizes = S.col("winner-size").cast("string")
    return df.withColumns(
        {
            "bidder-count": S.bidder_count(sizes),
            "primary-bidder-size": S.primary_size(sizes),
            "bidder-size-numeric": S.size_ordinal(S.primary_size(sizes)),
        }
    )


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per non-null value."""
    return df.filter(S.col(name).isNotNull()).groupBy(S.col(name).alias(name)).agg(F.count("*").alias("count"))


def value_counts_of(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """(field, value, count) of several text columns in one pass; ``names`` maps columns to field names."""
    pairs = [F.struct(F.lit(field).alias("field"), S.col(name).cast("string").alias("value")) for name, field in names.items()]
    return df.select(F.inline(F.array(*pairs))).filter("value is not null").groupBy("field", "value").agg(F.count("*").alias("count"))


def top_values_of(df: DataFrame, names: dict[str, str], n: int = 10) -> DataFrame:
    """The ``n`` most frequent values of each column, ties by value."""
    order = Window.partitionBy("field").orderBy(F.desc("count"), "value")
    return value_counts_of(df, names).withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= n).drop("_place")


def top_values(df: DataFrame, name: str, n: int = 10) -> DataFrame:
    return value_counts(df, name).orderBy(F.desc("count"), S.col(name)).limit(n)


def add_type_dummies(df: DataFrame, types: list[str] | None = None, n: int = 10) -> DataFrame:
    """0/1 columns for the ``n`` most frequent notice types.

    Column names are matched without regard to case, so a type that differs from an
    earlier one only in case gets a numbered suffix.
    """
    if "notice-type" not in df.columns:
        return df
    if types is None:
        types = [row[0] for row in top_values(df, "notice-type", n).collect()]
    taken = {name.lower() for name in df.columns}
    dummies = {}
    for kind in types:
        name, suffix = f"notice_is_{kind}", 2
        while name.lower() in taken:
            name, suffix = f"notice_is_{kind}_{suffix}", suffix + 1
        taken.add(name.lower())
        dummies[name] = S.equals_flag(S.col("notice-type"), kind)
    return df.withColumns(dummies) if dummies else df


def normalise(df: DataFrame) -> DataFrame:
    """The whole cleaning chain over raw notices."""
    for step in (drop_link_columns, add_currency, parse_money, add_eur, add_cap_and_flag, add_bidders, add_type_dummies):
        df = step(df)
    return df


def rates_table(spark) -> DataFrame:
    """The fixed rates as a nine-row table."""
    rows = ", ".join(f"('{code}', {rate}D)" for code, rate in EUR_RATES.items())
    return spark.sql(f"select * from values {rows} as rates(currency, rate)")


def join_rates(df: DataFrame) -> DataFrame:
    """``df`` with the rate of its currency, 1.0 where the currency is not listed."""
    joined = df.join(F.broadcast(rates_table(df.sparkSession)), "currency", "left")
    return joined.withColumn("rate", F.coalesce("rate", F.lit(1.0)))


def with_statistics(df: DataFrame, **statistics: Column) -> DataFrame:
    """Every row beside one-row aggregates of the whole table."""
    row = df.agg(*[expr.alias(name) for name, expr in statistics.items()])
    return df.crossJoin(F.broadcast(row))


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({name: F.coalesce(S.col(name), F.lit(0)) for name in columns})


def valid_counts(df: DataFrame) -> DataFrame:
    """Non-null numbers per money column and the highest bidder count, in one pass."""
    names = [name for name in (*MONEY_TEXT_COLUMNS, "total-value-eur") if name in df.columns]
    exprs = [F.count(S.col(name)).alias(name) for name in names]
    if "bidder-count" in df.columns:
        exprs.append(F.max("bidder-count").alias("max-bidders"))
    return df.agg(*exprs)


def keep_valued(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["total-value-eur"]) if "total-value-eur" in df.columns else df


def ml_columns(df: DataFrame) -> list[str]:
    """Columns of the learning table, in order. ``df`` must already hold only valued rows."""
    ids = [name for name in df.columns if has_fragment(name, ML_ID_FRAGMENTS)][:1]
    fixed = [name for name in (*ML_MONEY_COLUMNS, *ML_BIDDER_COLUMNS) if name in df.columns]
    dummies = [name for name in df.columns if name.startswith("notice_is_")]
    kept = list(dict.fromkeys(ids + fixed + dummies))
    others = [
        field.name
        for field in df.schema
        if field.name not in kept
        and isinstance(field.dataType, WIDE_NUMBERS)
        and not has_fragment(field.name, ML_SKIPPED_FRAGMENTS)
    ]
    if others:
        shares = df.agg(F.count("*").alias("_rows"), *[F.count(S.col(c)).alias(c) for c in others]).first()
        others = [name for name in others if shares["_rows"] and shares[name] / shares["_rows"] > 0.5]
    return kept + others[:5]


def prepare_for_ml(df: DataFrame) -> DataFrame:
    valued = keep_valued(df)
    return valued.select(*[S.col(name) for name in ml_columns(valued)])
