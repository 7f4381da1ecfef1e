"""Queries over raw and cleaned notices."""

from pyspark.sql import functions as F

from tenderlens.functions import scalars as S
from tenderlens.operators import cleaning, summaries
from tenderlens.plans.oracle import FLAGGED, NOTICES, VALUED, select
from tenderlens.plans.register import query
from tenderlens.session import materialise, scratch_path
from tenderlens.sources import pages, tables



def notice_id():
    return S.col("notice-identifier").alias("notice_id")


def publication_day():
    return F.date_format("publication-date", "yyyy-MM-dd").alias("publication_day")


def value_eur():
    return F.round(S.col("total-value-eur"), 6).alias("value_eur")


_DAY = "strftime(publication_date, '%Y-%m-%d') publication_day"


def column_fill(df):
    """(position, column_name, non_null) of every column, counted in one pass."""
    counts = df.agg(*[F.count(S.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("non_null")) for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*rows)))


@query(
    "p1_search_filter",
    select(
        NOTICES,
        f"select notice_id, {_DAY}, country from n where publication_date >= timestamp '1995-01-01' "
        "and publication_date < timestamp '1997-01-01' and country = 'NATION_7'",
    ),
)
def p1(spark, folder):
    found = pages.published_between(tables.notices(spark, folder), "1995-01-01", "1996-12-31", "NATION_7")
    return found.select(notice_id(), publication_day(), S.col("organisation-country-buyer").alias("country"))


@query(
    "p2_prune",
    select(NOTICES, "select notice_id, winner_size, notice_type, est_cur, total_value, country from n"),
)
def p2(spark, folder):
    return pages.requested(tables.notices(spark, folder)).toDF(
        "notice_id", "winner_size", "notice_type", "est_cur", "total_value", "country"
    )


@query(
    "p3_budget",
    select(
        NOTICES,
        "select notice_id, total_value from n where total_value is null or total_value = '' "
        "or try_cast(total_value as double) <= 150000",
    ),
)
def p3(spark, folder):
    return pages.within_budget(tables.notices(spark, folder), 150000).select(notice_id(), S.col("total-value").alias("total_value"))


@query("p4_page", select(NOTICES, f"select notice_id, {_DAY} from n order by publication_date, notice_id limit 500"))
def p4(spark, folder):
    return pages.first_pages(tables.notices(spark, folder)).select(notice_id(), publication_day())


@query(
    "p4_single_page",
    select(NOTICES, f"select notice_id, {_DAY} from n order by publication_date, notice_id limit 100 offset 12300"),
)
def p4_single(spark, folder):
    """Page 124 of an index."""
    index = pages.PageIndex.build(tables.notices(spark, folder), scratch_path(spark, "page_index"))
    return index.page(124).select(notice_id(), publication_day())


@query(
    "p5_lookback",
    select(
        NOTICES,
        f"select notice_id, {_DAY} from n where publication_date >= timestamp '1998-06-01' - interval 30 day "
        "and publication_date <= timestamp '1998-06-01'",
    ),
)
def p5(spark, folder):
    return pages.looking_back(tables.notices(spark, folder), 30, "1998-06-01 00:00:00").select(notice_id(), publication_day())


@query(
    "p6_drop_links",
    select(
        NOTICES,
        "select 0 as position, 'notice-identifier' as column_name, count(notice_id) non_null from n union all "
        "select 1, 'publication-date', count(publication_date) from n union all "
        "select 2, 'organisation-country-buyer', count(country) from n union all "
        "select 3, 'notice-type', count(notice_type) from n union all "
        "select 4, 'total-value', count(total_value) from n union all "
        "select 5, 'estimated-value-cur-proc', count(est_cur) from n union all "
        "select 6, 'winner-size', count(winner_size) from n",
    ),
)
def p6(spark, folder):
    linked = tables.notices(spark, folder)
    for name in ("Document-URL", "links.xml", "notice-html", "pdf-copy"):
        linked = linked.withColumn(name, S.col("notice-identifier"))
    return column_fill(cleaning.drop_link_columns(linked))


@query("p7_valid_value", select(VALUED, "select notice_id, round(eur, 6) value_eur from e where eur is not null"))
def p7(spark, folder):
    return cleaning.keep_valued(tables.valued_notices(spark, folder)).select(notice_id(), value_eur())


@query(
    "p8_ml_columns",
    select(
        FLAGGED,
        """select 0 as position, 'notice-identifier' as column_name, count(notice_id) non_null from v union all
select 1, 'total-value-eur', count(eur) from v union all
select 2, 'total-value-eur-capped', count(capped) from v union all
select 3, 'total-value-eur-log', count(log_eur) from v union all
select 4, 'bidder-count', count(bidders) from v union all
select 5, 'bidder-size-numeric', count(*) filter (bidder_size in ('micro', 'small', 'sme', 'medium', 'large')) from v union all
select cast(5 + pos as integer), concat('notice_is_', notice_type), (select count(*) from v) from t where pos <= 10 union all
select 16, 'total-value', count(amount) from v""",
        "t as (select notice_type, row_number() over (order by count(*) desc, notice_type) pos from c group by notice_type)",
        "v as (select * from c where eur is not null)",
    ),
)
def p8(spark, folder):
    normalised = materialise(cleaning.normalise(tables.notices(spark, folder)), "normalised")
    return column_fill(cleaning.prepare_for_ml(normalised))


@query(
    "p9_coalesce_alias",
    select(
        NOTICES,
        "select notice_id as id, coalesce(try_cast(total_value as double), 0.0) as value, country, "
        "coalesce(winner_size, 'unknown') as size from n",
    ),
)
def p9(spark, folder):
    raw = tables.notices(spark, folder)
    return raw.select(
        S.text_or_unknown(raw.columns, ("notice-identifier", "notice_id", "identifier")).alias("id"),
        S.number_or_zero(raw.columns, ("value_eur", "total-value")).alias("value"),
        S.text_or_unknown(raw.columns, ("organisation-country-buyer", "country")).alias("country"),
        S.text_or_unknown(raw.columns, ("winner-size",)).alias("size"),
    )


@query("c1_currency", select(VALUED, "select notice_id, currency from m"))
def c1(spark, folder):
    return cleaning.add_currency(tables.notices(spark, folder)).select(notice_id(), "currency")


@query("c2_money", select(VALUED, "select notice_id, round(amount, 6) as amount from m"))
def c2(spark, folder):
    parsed = cleaning.parse_money(tables.notices(spark, folder))
    return parsed.select(notice_id(), F.round(S.col("total-value"), 6).alias("amount"))


@query("c3_eur", select(VALUED, "select notice_id, round(eur, 6) value_eur from e"))
def c3(spark, folder):
    return tables.valued_notices(spark, folder).select(notice_id(), value_eur())


@query("c4_cap", select(FLAGGED, "select notice_id, round(capped, 6) capped from c"))
def c4(spark, folder):
    return tables.flagged_notices(spark, folder).select(notice_id(), F.round(S.col("total-value-eur-capped"), 6).alias("capped"))


@query("c5_flag", select(FLAGGED, "select notice_id, is_outlier from c"))
def c5(spark, folder):
    return tables.flagged_notices(spark, folder).select(notice_id(), "is_outlier")


@query("c6_log", select(VALUED, "select notice_id, round(ln(1 + coalesce(eur, 0)), 9) log_eur from e"))
def c6(spark, folder):
    valued = tables.valued_notices(spark, folder)
    return valued.select(notice_id(), F.round(S.log_value(S.col("total-value-eur")), 9).alias("log_eur"))


@query("c7_bidders", select(VALUED, "select notice_id, cast(bidders as integer) bidders from e"))
def c7(spark, folder):
    return cleaning.add_bidders(tables.notices(spark, folder)).select(notice_id(), S.col("bidder-count").alias("bidders"))


@query("c8_primary_size", select(VALUED, "select notice_id, bidder_size from e"))
def c8(spark, folder):
    return cleaning.add_bidders(tables.notices(spark, folder)).select(notice_id(), S.col("primary-bidder-size").alias("bidder_size"))


@query(
    "c9_size_ordinal",
    select(
        VALUED,
        "select notice_id, cast(case bidder_size when 'micro' then 1 when 'small' then 2 when 'sme' then 2.5 "
        "when 'medium' then 3 when 'large' then 4 end as double) size_numeric from e",
    ),
)
def c9(spark, folder):
    return cleaning.add_bidders(tables.notices(spark, folder)).select(notice_id(), S.col("bidder-size-numeric").alias("size_numeric"))


@query(
    "c10_type_dummies",
    select(
        NOTICES,
        "select concat('notice_is_', notice_type) dummy, count(*) as total from n group by notice_type "
        "order by count(*) desc, notice_type limit 10",
    ),
)
def c10(spark, folder):
    df = cleaning.add_type_dummies(tables.notices(spark, folder))
    names = [c for c in df.columns if c.startswith("notice_is_")]
    sums = df.agg(*[F.sum(S.col(c)).alias(c) for c in names])
    rows = [F.struct(F.lit(c).alias("dummy"), S.col(c).alias("total")) for c in names]
    return sums.select(F.inline(F.array(*rows)))


@query(
    "c11_label",
    select(FLAGGED, "select notice_id, case when is_outlier then 'OUTLIER' else 'NORMAL' end outlier_status from c"),
)
def c11(spark, folder):
    return tables.flagged_notices(spark, folder).select(notice_id(), S.status_label(F.col("is_outlier")).alias("outlier_status"))


def _label_sql(value):
    return (
        f"case when {value} >= 1e9 then printf('€%.1fB', {value} / 1e9) when {value} >= 1e6 then printf('€%.1fM', {value} / 1e6) "
        f"when {value} >= 1e3 then printf('€%.1fK', {value} / 1e3) when {value} is not null then printf('€%.0f', {value}) end"
    )


@query(
    "c14_currency_label",
    select(VALUED, f"select notice_id, {_label_sql('eur')} label, {_label_sql('(eur * 10000)')} large_label from e"),
)
def c14(spark, folder):
    value = S.col("total-value-eur")
    return tables.valued_notices(spark, folder).select(
        notice_id(), S.currency_label(value).alias("label"), S.currency_label(value * 10000).alias("large_label")
    )


@query("c16_fill_zero", select(VALUED, "select notice_id, round(coalesce(eur, 0), 6) value_eur from e"))
def c16(spark, folder):
    return cleaning.fill_zero(tables.valued_notices(spark, folder), ["total-value-eur"]).select(notice_id(), value_eur())


@query(
    "a1_value_counts",
    select(
        VALUED,
        "select 'currency' as field, currency as value, count(*) as n from m group by currency union all "
        "select 'winner_size', winner_size, count(*) from m where winner_size is not null group by winner_size union all "
        "select 'notice_type', notice_type, count(*) from m group by notice_type",
    ),
)
def a1(spark, folder):
    df = cleaning.add_currency(tables.notices(spark, folder))
    names = {"currency": "currency", "winner-size": "winner_size", "notice-type": "notice_type"}
    return cleaning.value_counts_of(df, names).withColumnRenamed("count", "n")


@query(
    "a2_valid_counts",
    select(VALUED, "select count(amount) total_value, count(eur) value_eur, cast(max(bidders) as integer) max_bidders from e"),
)
def a2(spark, folder):
    counts = cleaning.valid_counts(cleaning.add_bidders(tables.valued_notices(spark, folder)))
    return counts.toDF("total_value", "value_eur", "max_bidders")


@query(
    "a3_missing_profile",
    select(
        VALUED,
        "select feature, missing, round(missing * 100.0 / total, 6) missing_pct from miss where missing > 0",
        """miss as (select 'total-value' feature, count(*) filter (amount is null) missing, count(*) total from e union all
select 'winner-size', count(*) filter (winner_size is null), count(*) from e union all
select 'notice-type', count(*) filter (notice_type is null), count(*) from e union all
select 'estimated-value-cur-proc', count(*) filter (est_cur is null), count(*) from e)""",
    ),
)
def a3(spark, folder):
    names = ["total-value", "winner-size", "notice-type", "estimated-value-cur-proc"]
    profile = summaries.missing_profile(tables.valued_notices(spark, folder), names)
    return profile.withColumn("missing_pct", F.round("missing_pct", 6))


@query(
    "a4_outlier_share",
    select(
        FLAGGED,
        "select count(*) total_records, count(*) filter (is_outlier) outlier_count, "
        "round(count(*) filter (is_outlier) * 100.0 / count(*), 6) outlier_percentage from c",
    ),
)
def a4(spark, folder):
    share = summaries.outlier_share(tables.flagged_notices(spark, folder))
    return share.withColumn("outlier_percentage", F.round("outlier_percentage", 6))


@query(
    "w5_union_pages",
    select(
        NOTICES,
        "select notice_id, null as country, total_value from n where country = 'NATION_3' union all "
        "select notice_id, country, null as total_value from n where country in ('NATION_3', 'NATION_4')",
    ),
)
def w5(spark, folder):
    raw = tables.notices(spark, folder)
    country = S.col("organisation-country-buyer")
    first = raw.filter(country == "NATION_3").select(notice_id(), S.col("total-value").alias("total_value"))
    second = raw.filter(country.isin("NATION_3", "NATION_4")).select(notice_id(), country.alias("country"))
    return pages.union_pages([first, second])


@query("j3_rate_lookup", select(VALUED, "select notice_id, currency, round(eur, 6) value_eur from e"))
def j3(spark, folder):
    raw = cleaning.join_rates(cleaning.parse_money(cleaning.add_currency(tables.notices(spark, folder))))
    return raw.select(notice_id(), "currency", F.round(S.col("total-value") * F.col("rate"), 6).alias("value_eur"))


@query(
    "j4_stat_cross",
    select(
        VALUED,
        "select notice_id, round(eur / max(eur) over (), 9) of_top, round(eur - avg(eur) over (), 3) off_mean from e",
    ),
)
def j4(spark, folder):
    value = S.col("total-value-eur")
    beside = cleaning.with_statistics(tables.valued_notices(spark, folder), top=F.max(value), mean=F.avg(value))
    return beside.select(
        notice_id(), F.round(value / F.col("top"), 9).alias("of_top"), F.round(value - F.col("mean"), 3).alias("off_mean")
    )
