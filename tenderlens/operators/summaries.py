"""Aggregates over scored tables: metrics, reports and the datasets behind charts."""

from pyspark.sql import Column, DataFrame, functions as F

from tenderlens.functions import scalars as S
from tenderlens.functions.quantiles import exact_quantile, exact_quantiles
from tenderlens.operators.cleaning import top_values
from tenderlens.session import materialise
from tenderlens.schema import CHART_VALUE_NAMES, COUNTRY_NAMES, METRIC_VALUE_NAMES, first_present


def _flag() -> Column:
    return F.coalesce(F.col("is_outlier").cast("boolean"), F.lit(False))


def value_column(df: DataFrame, names=CHART_VALUE_NAMES) -> str | None:
    return first_present(df.columns, names)


def country_column(df: DataFrame) -> str | None:
    return first_present(df.columns, COUNTRY_NAMES)


def missing_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count and percent of nulls for each column that has any."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(S.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), S.col(c).alias("missing")) for c in columns])
    rows = counts.select("_rows", F.inline(pairs))
    share = S.percent(F.col("missing"), F.col("_rows"))
    return rows.filter("missing > 0").select("feature", "missing", share.alias("missing_pct"))


def is_flagged(df: DataFrame) -> bool:
    return "is_outlier" in df.columns


def outlier_share(df: DataFrame) -> DataFrame:
    """Rows, flagged rows and their percent; a table without flags has its number of rows only."""
    if not is_flagged(df):
        return df.agg(F.count("*").alias("total_records"))
    counts = df.agg(F.count("*").alias("total_records"), F.count_if(_flag()).alias("outlier_count"))
    share = S.percent(F.col("outlier_count"), F.col("total_records"))
    return counts.withColumn("outlier_percentage", share)


def _value_means(value: Column) -> list[Column]:
    return [F.avg(F.when(~_flag(), value)).alias("normal_avg"), F.avg(F.when(_flag(), value)).alias("outlier_avg")]


def _with_ratio(df: DataFrame) -> DataFrame:
    """Outlier mean 0 without outliers; ratio 0 unless the normal mean is positive."""
    outlier = F.when(F.col("outlier_count") > 0, F.col("outlier_avg")).otherwise(F.lit(0.0))
    ratio = F.when(F.col("normal_avg") > 0, F.try_divide("outlier_avg", "normal_avg")).otherwise(F.lit(0.0))
    return df.withColumn("outlier_avg", outlier).withColumn("value_ratio", ratio)


def outlier_panel(df: DataFrame, names=CHART_VALUE_NAMES) -> DataFrame:
    """Counts, shares and value means by flag, in one pass."""
    value = S.col(value_column(df, names))
    counts = df.agg(
        F.count("*").alias("total_records"), F.count_if(_flag()).alias("outlier_count"), *_value_means(value)
    )
    normal = F.col("total_records") - F.col("outlier_count")
    shares = counts.withColumns(
        {
            "normal_count": normal,
            "normal_percentage": S.percent(normal, F.col("total_records")),
            "outlier_percentage": S.percent(F.col("outlier_count"), F.col("total_records")),
        }
    )
    return _with_ratio(shares)


def value_statistics(df: DataFrame, names=METRIC_VALUE_NAMES) -> DataFrame:
    return outlier_panel(df, names).select("normal_avg", "outlier_avg", "value_ratio")


def evaluation(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """The metrics row of an evaluation; value figures only when a value column exists."""
    if value_column(df, METRIC_VALUE_NAMES):
        metrics = outlier_panel(df, METRIC_VALUE_NAMES)
        stats = F.struct(
            F.col("normal_avg").alias("normal_avg_value"),
            F.col("outlier_avg").alias("outlier_avg_value"),
            "value_ratio",
        )
    else:
        metrics, stats = outlier_share(df), F.lit(None)
    return metrics.select(
        "total_records",
        "outlier_count",
        "outlier_percentage",
        stats.alias("value_statistics"),
        S.stamp(as_of).alias("timestamp"),
    )


def top_countries(df: DataFrame, n: int = 10) -> DataFrame:
    return top_values(df, country_column(df), n)


def outlier_percent_by_country(df: DataFrame, n: int = 10) -> DataFrame:
    """Outlier share of the ``n`` countries with most rows, beside the share of the whole table.

    Both come from one grouping: the overall share is summed from the group counts.
    """
    name = country_column(df)
    groups = df.groupBy(S.col(name).alias("country")).agg(
        F.count("*").alias("count"), F.count_if(_flag()).alias("outliers")
    )
    overall = groups.agg(S.percent(F.sum("outliers"), F.sum("count")).alias("overall_percentage"))
    top = groups.filter("country is not null").orderBy(F.desc("count"), "country").limit(n)
    share = S.percent(F.col("outliers"), F.col("count"))
    return top.withColumn("percentage", share).crossJoin(F.broadcast(overall))


def mean_value_by_country(df: DataFrame, n: int = 10) -> DataFrame:
    named = df.filter(S.col(country_column(df)).isNotNull())
    means = named.groupBy(S.col(country_column(df)).alias("country")).agg(
        F.avg(S.col(value_column(df))).alias("mean_value")
    )
    return means.orderBy(F.desc_nulls_last("mean_value"), "country").limit(n)


def positive(df: DataFrame) -> DataFrame:
    return df.filter(S.col(value_column(df)) > 0)


def summary_statistics(df: DataFrame) -> DataFrame:
    """Counts, range, mean and median of positive values, and means by flag over all values.

    A table without flags has none of the figures that need them.
    """
    name = value_column(df)
    value = S.col(name)
    above_zero = F.when(value > 0, value)
    median = exact_quantile(df, above_zero, 0.5)
    flags = [F.count_if(_flag()).alias("outlier_count"), *_value_means(value)] if is_flagged(df) else []
    row = df.agg(
        F.count("*").alias("total_records"),
        F.min(above_zero).alias("minimum"),
        F.max(above_zero).alias("maximum"),
        F.avg(above_zero).alias("average"),
        *flags,
    ).withColumn("median", F.lit(median).cast("double"))
    if not flags:
        return row
    share = S.percent(F.col("outlier_count"), F.col("total_records"))
    return _with_ratio(row.withColumn("outlier_percentage", share))


def flag_shares(df: DataFrame) -> DataFrame:
    """Rows and percent per status; the total is summed from the two groups."""
    groups = df.groupBy(S.status_label(_flag()).alias("status")).agg(F.count("*").alias("count"))
    total = groups.agg(F.sum("count").alias("total"))
    share = S.percent(F.col("count"), F.col("total"))
    return groups.crossJoin(F.broadcast(total)).select("status", "count", share.alias("percentage"))


def _histogram(df: DataFrame, value: Column, group: Column, edges_by: Column, bins: int) -> DataFrame:
    """Counts per (group, bin) of ``bins`` equal bins between the lowest and highest value of ``edges_by``.

    Two passes, for the edges and for the counts, over the written value and status.
    """
    rows = df.select(value.alias("v"), group.alias("status"), edges_by.alias("edge_key")).filter("v is not null")
    rows = materialise(rows, "histogram")
    edges = rows.groupBy("edge_key").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    placed = rows.join(F.broadcast(edges), "edge_key")
    step = F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low")) * bins
    bin_ = F.least(F.coalesce(F.floor(step), F.lit(0)), F.lit(bins - 1)).cast("bigint")
    return placed.groupBy("status", bin_.alias("bin"), "low", "high").agg(F.count("*").alias("count"))


def log_histogram(df: DataFrame, bins: int | None = None) -> DataFrame:
    """Positive values in equal bins of log10, each status over its own range.

    20 bins per status, 30 for a table without flags; the last bin includes its upper edge.
    """
    flagged = "is_outlier" in df.columns
    status = S.status_label(_flag()) if flagged else F.lit("ALL")
    value = F.log10(S.col(value_column(df)))
    return _histogram(positive(df), value, status, status, bins or (20 if flagged else 30))


def score_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    """Anomaly scores by status over shared edges."""
    return _histogram(df, F.col("anomaly_score"), S.status_label(_flag()), F.lit(0), bins)


def _boxes(df: DataFrame) -> DataFrame:
    """(status, v, q1, median, q3, inside) of positive values."""
    value = S.col(value_column(df))
    flagged = "is_outlier" in df.columns
    status = S.status_label(_flag()) if flagged else F.lit("ALL")
    names = ("NORMAL", "OUTLIER") if flagged else ("ALL",)
    rows = materialise(positive(df).select(status.alias("status"), value.cast("double").alias("v")), "boxes")
    probabilities = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    own = {g: F.when(F.col("status") == g, F.col("v")) for g in names}
    found = exact_quantiles(rows, {(g, q): (own[g], p) for g in names for q, p in probabilities.items()})
    # One row per status; a status without rows meets none below.
    quartiles = [(g, *[found[(g, q)] for q in probabilities]) for g in names]
    quartiles = df.sparkSession.createDataFrame(quartiles, "status string, q1 double, median double, q3 double")
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("v").between(F.col("q1") - spread, F.col("q3") + spread)
    return rows.join(F.broadcast(quartiles), "status").withColumn("inside", inside)


def box_fliers(df: DataFrame) -> DataFrame:
    """(status, value) of the positive values beyond the whiskers."""
    return _boxes(df).filter("not inside").select("status", F.col("v").alias("value"))


def box_statistics(df: DataFrame) -> DataFrame:
    """Quartiles, whiskers and flier count of positive values per status (or overall)."""
    inside = F.col("inside")
    return _boxes(df).groupBy("status", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("v"))).alias("high_whisker"),
        F.count_if(~inside).alias("fliers"),
        F.count("*").alias("count"),
    )


def score_points(df: DataFrame) -> DataFrame:
    """Score and value of every row with its status."""
    return df.select(
        F.col("anomaly_score"), S.col(value_column(df)).alias("value"), S.status_label(_flag()).alias("status")
    )


def score_threshold(df: DataFrame) -> DataFrame:
    """The lowest score among outliers."""
    return df.agg(F.min(F.when(_flag(), F.col("anomaly_score"))).alias("threshold"))


def report(df: DataFrame, statistics: DataFrame, days: int = 30, as_of: str | None = None) -> DataFrame:
    """The report row: figures of the table beside the statistics of all stored runs."""
    figures = outlier_share(df).withColumnsRenamed({"total_records": "record_count"})
    stored = statistics.select(F.struct("*").alias("summary_statistics"))
    return figures.crossJoin(F.broadcast(stored)).select(
        S.stamp(as_of).alias("report_date"),
        F.lit(f"{days} days").alias("data_period"),
        *[name for name in ("record_count", "outlier_count", "outlier_percentage") if name in figures.columns],
        "summary_statistics",
    )
