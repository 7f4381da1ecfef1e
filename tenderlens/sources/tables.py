"""Notices, stored runs, feature rows and points derived from order tables.

The engine's own inputs are landed notices; where only order data is at hand, these
views give it the same shape: every order is a notice, its buyer's nation the
country, its price the money text.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderlens.functions import scalars as S
from tenderlens.functions.quantiles import exact_quantiles
from tenderlens.operators import cleaning
from tenderlens.operators.runs import result_rows
from tenderlens.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def notices(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as raw notices, all text but the date."""
    orders, customer, nation = (table(spark, folder, name) for name in ("orders", "customer", "nation"))
    # Deriving the texts is work per row; a small orders table is one split.
    orders = spread(orders)
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    cents = joined.selectExpr("*", "cast(round(o_totalprice * 100) as bigint) as cents")
    parts = cents.selectExpr(
        "*", "cast(cents div 100 as string) as w", "lpad(cast(cents % 100 as string), 2, '0') as f"
    )
    return parts.selectExpr(
        "cast(o_orderkey as string) as `notice-identifier`",
        "o_orderdate as `publication-date`",
        "n_name as `organisation-country-buyer`",
        "concat(o_orderpriority, '/', o_orderstatus) as `notice-type`",
        """case o_orderkey % 13 when 0 then null when 1 then 'invalid'
             when 2 then concat('1,', w, '.', f) when 3 then concat(w, ',', f)
             when 4 then concat('EUR ', w, '.', f) when 5 then concat('-', w, '.', f)
             else concat(w, '.', f) end as `total-value`""",
        """case o_orderkey % 11 when 0 then 'EUR 1000' when 1 then 'SEK 1000' when 2 then 'BGN 1000'
             when 3 then 'NOK 1000' when 4 then 'PLN 1000' when 5 then 'CZK 1000' when 6 then 'HUF 1000'
             when 7 then 'DKK 1000' when 8 then 'RON 1000' when 9 then 'USD 1000'
             else null end as `estimated-value-cur-proc`""",
        """case o_custkey % 6 when 0 then null when 1 then 'small|medium' when 2 then 'large'
             when 3 then 'micro' when 4 then 'sme|sme|small' else 'unknown' end as `winner-size`""",
    )


def valued_notices(spark: SparkSession, folder: str) -> DataFrame:
    """Notices with parsed money and the EUR value."""
    return cleaning.add_eur(cleaning.parse_money(cleaning.add_currency(notices(spark, folder))))


def flagged_notices(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.add_cap_and_flag(valued_notices(spark, folder))


def scored_notices(spark: SparkSession, folder: str) -> DataFrame:
    """Flagged notices with value / highest value as score."""
    valued = valued_notices(spark, folder)
    value = S.col("total-value-eur")
    found = exact_quantiles(valued, {"limit": (value, 0.95), "top": (value, 1.0)})
    score = S.round_score(F.try_divide(value, F.lit(found["top"]).cast("double")))
    return cleaning.add_cap_and_flag(valued, found["limit"]).withColumn("anomaly_score", score)


def results(spark: SparkSession, folder: str) -> DataFrame:
    """Stored result rows: one run per order year."""
    run_id = F.concat(F.lit("run-"), F.date_format("publication-date", "yyyy"))
    return result_rows(scored_notices(spark, folder).withColumn("run_id", run_id), F.col("run_id"))


def runs(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """Metadata of the runs in :func:`results`."""
    rows = results(spark, folder) if rows is None else rows
    stats = rows.groupBy("run_id").agg(
        F.count("*").alias("record_count"), F.sum(F.col("is_outlier").cast("bigint")).alias("outlier_count")
    )
    year = F.substring("run_id", 5, 4)
    number = year.cast("int")
    return stats.select(
        "run_id",
        F.when(number % 3 == 0, "isolation_forest").when(number % 3 == 1, "dbscan").otherwise("kmeans").alias("model_type"),
        F.when(
            number % 4 != 0, F.concat(F.lit('{"contamination":"0.05","year":"'), year, F.lit('"}'))
        ).when(number % 8 == 0, "not json").alias("parameters"),
        F.concat(year, F.lit("-06-15 12:00:00")).alias("execution_date"),
        "record_count",
        "outlier_count",
        S.percent(F.col("outlier_count"), F.col("record_count")).alias("outlier_percentage"),
        F.concat(F.lit("orders of "), year).alias("notes"),
    )


def feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Per notice: EUR value, its log, summed quantity and discount of its lines, and two texts."""
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("quantity"), F.sum("l_discount").alias("discount"))
        .select("l_orderkey", F.round("quantity", 6).alias("quantity"), F.round("discount", 6).alias("discount"))
    )
    base = cleaning.add_bidders(valued_notices(spark, folder))
    base = base.withColumn("total-value-eur-log", S.log_value(S.col("total-value-eur")))
    # Both sides shuffle numbers; the text key is made from one.
    return base.join(lines, S.col("notice-identifier").cast("bigint") == F.col("l_orderkey"), "left").select(
        "notice-identifier",
        "total-value-eur",
        "total-value-eur-log",
        "quantity",
        "discount",
        "bidder-count",
        "notice-type",
        "primary-bidder-size",
    )


def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer"), F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation")
    )


def supplier_features(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supplier"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")
    )
