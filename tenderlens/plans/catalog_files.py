"""Queries over files that Spark writes from the tables and reads back."""

from pyspark.sql import functions as F

from tenderlens.functions import scalars as S
from tenderlens.operators import cleaning
from tenderlens.plans.catalog_notices import notice_id, value_eur
from tenderlens.plans.oracle import FLAGGED, NOTICES, select
from tenderlens.plans.register import query
from tenderlens.session import materialise, scratch_path
from tenderlens.sources import csvfiles, pages, tables

_NOTICE = "notice_id, strftime(publication_date, '%Y-%m-%d') publication_day, country, notice_type, total_value, est_cur, winner_size"
_NAMES = ("notice_id", "publication_day", "country", "notice_type", "total_value", "est_cur", "winner_size")


def dated_notices(spark, folder):
    raw = tables.notices(spark, folder)
    return raw.withColumn("publication-date", F.date_format("publication-date", "yyyy-MM-dd"))


@query("s1_pages", select(NOTICES, f"select {_NOTICE} from n"))
def s1(spark, folder):
    raw = dated_notices(spark, folder)
    path = scratch_path(spark, "pages")
    pages.write_pages(raw, path)
    return pages.read_pages(spark, path, raw.schema, page_per_line=True).toDF(*_NAMES)


@query(
    "s2_flatten",
    select(
        NOTICES,
        "select notice_id, total_value as values_total, est_cur as values_currency, country as organisation_country, "
        "notice_type || '|' || coalesce(winner_size, 'None') as tags, "
        "case when winner_size is null then '{}' else '{\"size\":\"' || winner_size || '\"}' end as organisation_detail from n",
    ),
)
def s2(spark, folder):
    raw = tables.notices(spark, folder)
    nested = raw.select(
        S.col("notice-identifier").alias("notice-id"),
        F.struct(S.col("total-value").alias("total"), S.col("estimated-value-cur-proc").alias("currency")).alias("values"),
        F.struct(
            S.col("organisation-country-buyer").alias("country"), F.struct(S.col("winner-size").alias("size")).alias("detail")
        ).alias("organisation"),
        F.array(S.col("notice-type"), S.col("winner-size")).alias("tags"),
    )
    flat = pages.flatten(nested)
    return flat.select(
        S.col("notice-id").alias("notice_id"),
        S.col("values.total").alias("values_total"),
        S.col("values.currency").alias("values_currency"),
        S.col("organisation.country").alias("organisation_country"),
        "tags",
        S.col("organisation.detail").alias("organisation_detail"),
    )


@query("s3_csv", select(NOTICES, f"select {_NOTICE} from n"))
def s3(spark, folder):
    raw = dated_notices(spark, folder)
    path = csvfiles.write_csv(raw, scratch_path(spark, "csv"))
    return csvfiles.read_csv(spark, path, raw.schema).toDF(*_NAMES)


@query(
    "s4_ragged_csv",
    select(
        NOTICES,
        "select case when k0 % 7 = 0 then '' else notice_id end id, "
        "case when k0 % 7 = 0 or k0 % 5 = 0 then '' else country end country, "
        "case when k0 % 7 = 0 or k0 % 5 = 0 then '' else coalesce(replace(total_value, '.', ','), '') end total, "
        "case when k0 % 7 <> 0 and k0 % 5 <> 0 and k0 % 3 = 0 then 'say \"hi\",' || chr(10) || 'there' else '' end unknown_3, "
        "case when k0 % 7 <> 0 and k0 % 5 <> 0 and k0 % 3 = 0 then notice_type else '' end unknown_4 from "
        "(select *, cast(notice_id as bigint) k0 from n)",
    ),
)
def s4(spark, folder):
    """Records of 0, 1, 3 or 5 fields, some of them quoted or with a line break, under a header of 3."""
    number = S.col("notice-identifier").cast("bigint")
    total = F.concat(F.lit('"'), F.coalesce(F.replace(S.col("total-value"), F.lit("."), F.lit(",")), F.lit("")), F.lit('"'))
    usual = F.concat_ws(",", S.col("notice-identifier"), S.col("organisation-country-buyer"), total)
    long = F.concat_ws(",", usual, F.lit('"say ""hi"",\nthere"'), S.col("notice-type"))
    line = (
        F.when(number % 7 == 0, "")
        .when(number % 5 == 0, S.col("notice-identifier"))
        .when(number % 3 == 0, long)
        .otherwise(usual)
    )
    path = scratch_path(spark, "ragged")
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    headed = F.when(first, F.concat(F.lit("id,country,total\n"), F.col("line"))).otherwise(F.col("line"))
    tables.notices(spark, folder).select(line.alias("line")).select(headed.alias("value")).write.text(path)
    return csvfiles.read_ragged_csv(spark, path)


@query(
    "s5_csv_sink",
    select(
        FLAGGED,
        "select notice_id, round(eur, 6) value_eur, round(capped, 6) capped, round(log_eur, 9) log_eur from c where eur is not null",
    ),
)
def s5(spark, folder):
    normalised = materialise(cleaning.normalise(tables.notices(spark, folder)), "normalised")
    table = cleaning.prepare_for_ml(normalised)
    path = csvfiles.write_csv(table, scratch_path(spark, "ml"))
    back = csvfiles.read_csv(spark, path, table.schema)
    return back.select(
        notice_id(),
        value_eur(),
        F.round(S.col("total-value-eur-capped"), 6).alias("capped"),
        F.round(S.col("total-value-eur-log"), 9).alias("log_eur"),
    )
