"""Queries over stored runs and scored tables."""

from pyspark.sql import functions as F

from tenderlens.functions import scalars as S
from tenderlens.operators import cleaning, runs, summaries
from tenderlens.plans.oracle import FLAGGED, RESULTS, select
from tenderlens.plans.register import query
from tenderlens.session import materialise, scratch_path
from tenderlens.sources import csvfiles, tables

RUN = "run-1997"
AS_OF = "2001-01-01 00:00:00"


def both(spark, folder):
    """Result rows, written once, and the metadata of their runs."""
    rows = materialise(tables.results(spark, folder), "results")
    return rows, tables.runs(spark, folder, rows)


def rounded(df, **places):
    return df.withColumns({name: F.round(name, digits) for name, digits in places.items()})


_ROW = "run_id, notice_id, round(value_eur, 6) value_eur, country, notice_type, is_outlier, round(anomaly_score, 4) anomaly_score"


_AWKWARD_SQL = "case when notice_type = 'unknown' then notice_type else '\"' || notice_type || '\",' || chr(10) || 'or \"so\"' end notice_type"


def shown(rows):
    return rounded(rows, value_eur=6, anomaly_score=4)


@query("p10_result_rows", select(RESULTS, f"select {_ROW} from r"))
def p10(spark, folder):
    return shown(tables.results(spark, folder))


@query("p11_positive", select(FLAGGED, "select notice_id, round(eur, 6) value_eur from c where eur > 0"))
def p11(spark, folder):
    found = summaries.positive(tables.valued_notices(spark, folder))
    return found.select(S.col("notice-identifier").alias("notice_id"), F.round(S.col("total-value-eur"), 6).alias("value_eur"))


_MEANS = (
    "round(avg(eur) filter (not is_outlier), 4) normal_avg, "
    "round(case when count(*) filter (is_outlier) > 0 then avg(eur) filter (is_outlier) else 0 end, 4) outlier_avg, "
    "round(case when avg(eur) filter (not is_outlier) > 0 "
    "then avg(eur) filter (is_outlier) / avg(eur) filter (not is_outlier) else 0 end, 6) value_ratio"
)


@query(
    "p12_split_stats",
    select(
        FLAGGED,
        f"select count(*) filter (not is_outlier) normal_count, count(*) filter (is_outlier) outlier_count, {_MEANS} from c",
    ),
)
def p12(spark, folder):
    panel = summaries.outlier_panel(tables.flagged_notices(spark, folder))
    panel = rounded(panel, normal_avg=4, outlier_avg=4, value_ratio=6)
    return panel.select("normal_count", "outlier_count", "normal_avg", "outlier_avg", "value_ratio")


@query(
    "p13_top_outliers",
    select(
        RESULTS,
        f"select {_ROW} from r where run_id = '{RUN}' and is_outlier = 1 order by anomaly_score desc, notice_id limit 100",
    ),
)
def p13(spark, folder):
    return shown(runs.top_outliers(tables.results(spark, folder), RUN))


@query(
    "p14_recent_runs",
    select(
        RESULTS,
        "select run_id, model_type, execution_date, record_count, outlier_count, "
        "round(outlier_percentage, 6) outlier_percentage, notes from runs order by execution_date desc, run_id limit 10",
    ),
)
def p14(spark, folder):
    return rounded(runs.recent_runs(both(spark, folder)[1]), outlier_percentage=6)


@query("p15_run_rows", select(RESULTS, f"select {_ROW} from r where run_id = '{RUN}'"))
def p15(spark, folder):
    return shown(runs.run_rows(tables.results(spark, folder), RUN))


@query(
    "p16_results_by_date",
    select(
        RESULTS,
        f"select {_ROW}, execution_date from r join runs using (run_id) "
        "where substr(execution_date, 1, 10) between '1995-01-01' and '1998-06-15' "
        "order by execution_date desc, run_id, notice_id",
    ),
)
def p16(spark, folder):
    return shown(runs.results_between(*both(spark, folder), "1995-01-01", "1998-06-15"))


@query(
    "p17_retention",
    select(
        RESULTS,
        "select run_id, count(*) as kept_rows from r where run_id in "
        "(select run_id from runs where execution_date >= '1996-06-15') group by run_id",
    ),
)
def p17(spark, folder):
    rows, metadata = both(spark, folder)
    # The run of 15 June 1996 is dated exactly on the cutoff day and stays.
    kept = runs.retained(rows, metadata, 30, "1996-07-15")
    return kept.groupBy("run_id").agg(F.count("*").alias("kept_rows"))


@query(
    "s8_store_run",
    select(
        FLAGGED,
        "select 'run-a' run_id, 'kmeans' model_type, '{\"k\": 5}' parameters, '2001-01-01 00:00:00' execution_date, "
        "count(*) record_count, count(*) filter (is_outlier) outlier_count, "
        "round(count(*) filter (is_outlier) * 100.0 / count(*), 6) outlier_percentage, 'stored' notes, "
        "round(sum(coalesce(eur, 0)), 2) stored_value from c",
    ),
)
def s8(spark, folder):
    store = runs.RunStore(spark, scratch_path(spark, "store"))
    store.store("kmeans", tables.scored_notices(spark, folder), {"k": 5}, "stored", AS_OF, "run-a")
    total = store.rows.groupBy("run_id").agg(F.round(F.sum("value_eur"), 2).alias("stored_value"))
    return rounded(store.runs, outlier_percentage=6).join(total, "run_id")


@query(
    "s9_export",
    select(
        RESULTS,
        f"select {_ROW.replace('run_id, ', '').replace('notice_type', _AWKWARD_SQL)} from r",
    ),
)
def s9(spark, folder):
    """Notice types hold a quote, a comma and a line break each."""
    store = runs.RunStore(spark, scratch_path(spark, "store"))
    awkward = F.concat(F.lit('"'), S.col("notice-type"), F.lit('",\nor "so"'))
    run_id = store.store("dbscan", tables.scored_notices(spark, folder).withColumn("notice-type", awkward), executed_at=AS_OF)
    path = scratch_path(spark, "export")
    store.export_csv(run_id, path)
    schema = (
        "run_id string, notice_id string, value_eur double, country string, notice_type string, "
        "is_outlier int, anomaly_score double"
    )
    return shown(csvfiles.read_csv(spark, path, schema)).drop("run_id")


@query("a5_value_stats", select(FLAGGED, f"select {_MEANS} from c"))
def a5(spark, folder):
    stats = summaries.value_statistics(tables.flagged_notices(spark, folder))
    return rounded(stats, normal_avg=4, outlier_avg=4, value_ratio=6)


@query(
    "a6_evaluation",
    select(
        FLAGGED,
        "select count(*) total_records, count(*) filter (is_outlier) outlier_count, "
        f"round(count(*) filter (is_outlier) * 100.0 / count(*), 6) outlier_percentage, {_MEANS}, "
        "'2001-01-01 00:00:00' as timestamp from c",
    ),
)
def a6(spark, folder):
    metrics = summaries.evaluation(tables.flagged_notices(spark, folder), AS_OF)
    return metrics.select(
        "total_records",
        "outlier_count",
        F.round("outlier_percentage", 6).alias("outlier_percentage"),
        F.round("value_statistics.normal_avg_value", 4).alias("normal_avg"),
        F.round("value_statistics.outlier_avg_value", 4).alias("outlier_avg"),
        F.round("value_statistics.value_ratio", 6).alias("value_ratio"),
        "timestamp",
    )


_OUTLIER_STATS = (
    "count(*) total_outliers, round(avg(anomaly_score), 6) avg_score, round(min(value_eur), 6) min_value, "
    f"round(max(value_eur), 6) max_value, round(avg(value_eur), 4) avg_value from r where run_id = '{RUN}' and is_outlier = 1"
)


@query("a7_run_outlier_stats", select(RESULTS, f"select {_OUTLIER_STATS}"))
def a7(spark, folder):
    stats = runs.outlier_statistics(tables.results(spark, folder), RUN)
    return rounded(stats, avg_score=6, min_value=6, max_value=6, avg_value=4)


_COUNTRIES = (
    "select country, count(*) total, cast(sum(is_outlier) as bigint) outliers, round(avg(is_outlier) * 100, 2) outlier_pct "
    f"from r where run_id = '{RUN}' group by country order by total desc, country limit 10"
)


@query("a8_country_breakdown", select(RESULTS, _COUNTRIES))
def a8(spark, folder):
    return runs.country_breakdown(tables.results(spark, folder), RUN)


@query(
    "a9_run_summary",
    select(
        RESULTS,
        "select run_id, model_type, record_count, outlier_count, '0.05' contamination, s.*, k.* exclude (country), "
        f"country as country from runs, (select {_OUTLIER_STATS}) s, ({_COUNTRIES}) k where run_id = '{RUN}'",
    ),
)
def a9(spark, folder):
    rows, metadata = both(spark, folder)
    summary = runs.run_summary(rows, metadata, RUN)
    flat = summary.select(
        "run_id",
        "model_type",
        "record_count",
        "outlier_count",
        F.col("parameter_map")["contamination"].alias("contamination"),
        "outlier_stats.*",
        F.inline("country_breakdown"),
    )
    return rounded(flat, avg_score=6, min_value=6, max_value=6, avg_value=4)


@query(
    "a10_statistics",
    select(
        RESULTS,
        "select (select count(*) from runs) total_runs, (select min(execution_date) from runs) first_run, "
        "(select max(execution_date) from runs) last_run, count(*) total_records, "
        "count(*) filter (is_outlier = 1) total_outliers, "
        "round(count(*) filter (is_outlier = 1) * 100.0 / count(*), 6) overall_outlier_percentage from r",
    ),
)
def a10(spark, folder):
    return rounded(runs.overall_statistics(*both(spark, folder)), overall_outlier_percentage=6)


@query("a11_runs_per_model", select(RESULTS, "select model_type, count(*) as count from runs group by model_type"))
def a11(spark, folder):
    return runs.runs_per_model(both(spark, folder)[1])


@query(
    "a12_top_countries",
    select(FLAGGED, "select country, count(*) as count from c group by country order by count(*) desc, country limit 10"),
)
def a12(spark, folder):
    return summaries.top_countries(tables.notices(spark, folder)).toDF("country", "count")


_BY_COUNTRY = (
    "select country, count(*) as count, count(*) filter (is_outlier) outliers, "
    "round(count(*) filter (is_outlier) * 100.0 / count(*), 6) percentage, "
    "(select round(count(*) filter (is_outlier) * 100.0 / count(*), 6) from c) overall_percentage "
    "from c group by country order by count(*) desc, country limit 10"
)


@query("a13_outlier_pct_country", select(FLAGGED, _BY_COUNTRY))
def a13(spark, folder):
    found = summaries.outlier_percent_by_country(tables.flagged_notices(spark, folder))
    return rounded(found, percentage=6, overall_percentage=6)


@query(
    "a14_mean_value_country",
    select(
        FLAGGED,
        "select country, round(avg(eur), 4) mean_value from c group by country order by avg(eur) desc, country limit 10",
    ),
)
def a14(spark, folder):
    return rounded(summaries.mean_value_by_country(tables.valued_notices(spark, folder)), mean_value=4)


@query(
    "a15_summary_stats",
    select(
        FLAGGED,
        "select count(*) total_records, count(*) filter (is_outlier) outlier_count, "
        "round(count(*) filter (is_outlier) * 100.0 / count(*), 6) outlier_percentage, "
        "round(min(eur) filter (eur > 0), 6) minimum, round(max(eur) filter (eur > 0), 6) maximum, "
        "round(avg(eur) filter (eur > 0), 4) average, "
        f"round((select quantile_cont(eur, 0.5) from c where eur > 0), 4) median, {_MEANS} from c",
    ),
)
def a15(spark, folder):
    stats = summaries.summary_statistics(tables.flagged_notices(spark, folder))
    return rounded(
        stats, outlier_percentage=6, minimum=6, maximum=6, average=4, median=4, normal_avg=4, outlier_avg=4, value_ratio=6
    )


@query(
    "a15_summary_unflagged",
    select(
        FLAGGED,
        "select count(*) total_records, round(min(eur) filter (eur > 0), 6) minimum, round(max(eur) filter (eur > 0), 6) maximum, "
        "round(avg(eur) filter (eur > 0), 4) average, "
        "round((select quantile_cont(eur, 0.5) from c where eur > 0), 4) median from c",
    ),
)
def a15_unflagged(spark, folder):
    stats = summaries.summary_statistics(tables.flagged_notices(spark, folder).drop("is_outlier"))
    return rounded(stats, minimum=6, maximum=6, average=4, median=4)


@query(
    "a16_outlier_panel",
    select(
        FLAGGED,
        "select count(*) total_records, count(*) filter (is_outlier) outlier_count, count(*) filter (not is_outlier) normal_count, "
        "round(count(*) filter (not is_outlier) * 100.0 / count(*), 6) normal_percentage, "
        f"round(count(*) filter (is_outlier) * 100.0 / count(*), 6) outlier_percentage, {_MEANS} from c",
    ),
)
def a16(spark, folder):
    panel = summaries.outlier_panel(tables.flagged_notices(spark, folder))
    return rounded(panel, normal_percentage=6, outlier_percentage=6, normal_avg=4, outlier_avg=4, value_ratio=6)


@query(
    "a17_share",
    select(
        FLAGGED,
        "select case when is_outlier then 'OUTLIER' else 'NORMAL' end status, count(*) as count, "
        "round(count(*) * 100.0 / (select count(*) from c), 6) percentage from c group by is_outlier",
    ),
)
def a17(spark, folder):
    return rounded(summaries.flag_shares(tables.flagged_notices(spark, folder)), percentage=6)


_EDGES = (
    "select case when is_outlier then 'OUTLIER' else 'NORMAL' end status, log10(eur) v, "
    "min(log10(eur)) over (partition by is_outlier) low, max(log10(eur)) over (partition by is_outlier) high from c where eur > 0"
)


@query(
    "a18_log_histogram",
    select(
        FLAGGED,
        "select status, least(coalesce(cast(floor((v - low) / (high - low) * 20) as bigint), 0), 19) as bin, "
        f"round(low, 9) low, round(high, 9) high, count(*) as count from ({_EDGES}) group by all",
    ),
)
def a18(spark, folder):
    return rounded(summaries.log_histogram(tables.flagged_notices(spark, folder)), low=9, high=9)


@query(
    "a18_log_histogram_unflagged",
    select(
        FLAGGED,
        "select 'ALL' status, least(cast(floor((v - low) / (high - low) * 30) as bigint), 29) as bin, "
        "round(low, 9) low, round(high, 9) high, count(*) as count from "
        "(select log10(eur) v, min(log10(eur)) over () low, max(log10(eur)) over () high from c where eur > 0) group by all",
    ),
)
def a18_unflagged(spark, folder):
    return rounded(summaries.log_histogram(tables.valued_notices(spark, folder)), low=9, high=9)


@query(
    "a19_score_histogram",
    select(
        FLAGGED,
        "select case when is_outlier then 'OUTLIER' else 'NORMAL' end status, "
        "least(cast(floor((score - low) / (high - low) * 20) as bigint), 19) as bin, round(low, 6) low, round(high, 6) high, "
        "count(*) as count from (select *, min(score) over () low, max(score) over () high from c where score is not null) "
        "group by all",
    ),
)
def a19(spark, folder):
    return rounded(summaries.score_histogram(tables.scored_notices(spark, folder)), low=6, high=6)


_QUARTILES = (
    "pos as (select case when is_outlier then 'OUTLIER' else 'NORMAL' end status, eur from c where eur > 0)",
    "qs as (select status, quantile_cont(eur, 0.25) q1, quantile_cont(eur, 0.5) median, quantile_cont(eur, 0.75) q3 "
    "from pos group by status)",
)


@query(
    "a20_box_stats",
    select(
        FLAGGED,
        """select qs.status, round(q1, 6) q1, round(median, 6) median, round(q3, 6) q3,
  round(min(eur) filter (eur between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6) low_whisker,
  round(max(eur) filter (eur between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6) high_whisker,
  count(*) filter (not (eur between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) fliers, count(*) as count
from pos join qs on pos.status = qs.status group by qs.status, q1, median, q3""",
        *_QUARTILES,
    ),
)
def a20(spark, folder):
    boxes = summaries.box_statistics(tables.flagged_notices(spark, folder))
    return rounded(boxes, q1=6, median=6, q3=6, low_whisker=6, high_whisker=6)


@query(
    "a20_box_fliers",
    select(
        FLAGGED,
        "select pos.status, round(eur, 6) as value from pos join qs on pos.status = qs.status "
        "where not (eur between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))",
        *_QUARTILES,
    ),
)
def a20_fliers(spark, folder):
    return rounded(summaries.box_fliers(tables.flagged_notices(spark, folder)), value=6)


@query(
    "a21_score_threshold",
    select(
        FLAGGED,
        "select round(min(score) filter (is_outlier), 4) threshold from c",
    ),
)
def a21(spark, folder):
    return rounded(summaries.score_threshold(tables.scored_notices(spark, folder)), threshold=4)


@query(
    "a21_score_points",
    select(
        FLAGGED,
        "select round(score, 4) anomaly_score, round(eur, 6) as value, "
        "case when is_outlier then 'OUTLIER' else 'NORMAL' end status from c",
    ),
)
def a21_points(spark, folder):
    return rounded(summaries.score_points(tables.scored_notices(spark, folder)), anomaly_score=4, value=6)


_REPORT = (
    "select '2001-01-01 00:00:00' report_date, '30 days' data_period, count(*) record_count, "
    "count(*) filter (is_outlier = 1) outlier_count, "
    "round(count(*) filter (is_outlier = 1) * 100.0 / count(*), 6) outlier_percentage, "
    "(select count(*) from runs) total_runs, (select count(*) from r) total_records from r"
)


def _report_row(row):
    return row.select(
        "report_date",
        "data_period",
        "record_count",
        "outlier_count",
        F.round("outlier_percentage", 6).alias("outlier_percentage"),
        "summary_statistics.total_runs",
        "summary_statistics.total_records",
    )


def report_row(spark, folder):
    rows, metadata = both(spark, folder)
    return summaries.report(rows, runs.overall_statistics(rows, metadata), 30, AS_OF)


@query("a22_report", select(RESULTS, _REPORT))
def a22(spark, folder):
    return _report_row(report_row(spark, folder))


@query("s7_report_json", select(RESULTS, _REPORT))
def s7(spark, folder):
    row = report_row(spark, folder)
    path = csvfiles.write_json(row, scratch_path(spark, "report"))
    return _report_row(spark.read.schema(row.schema).json(path))


@query(
    "s6_metrics_json",
    select(
        FLAGGED,
        f"select count(*) total_records, count(*) filter (is_outlier) outlier_count, {_MEANS} from c",
    ),
)
def s6(spark, folder):
    metrics = summaries.evaluation(tables.flagged_notices(spark, folder), AS_OF)
    path = csvfiles.write_json(metrics, scratch_path(spark, "metrics"))
    back = spark.read.schema(metrics.schema).json(path)
    return back.select(
        "total_records",
        "outlier_count",
        F.round("value_statistics.normal_avg_value", 4).alias("normal_avg"),
        F.round("value_statistics.outlier_avg_value", 4).alias("outlier_avg"),
        F.round("value_statistics.value_ratio", 6).alias("value_ratio"),
    )


@query("c12_round_score", select(FLAGGED, "select notice_id, round_even(eur / top, 4) score from c"))
def c12(spark, folder):
    scored = tables.scored_notices(spark, folder)
    return scored.select(S.col("notice-identifier").alias("notice_id"), F.col("anomaly_score").alias("score"))


@query(
    "c15_params_json",
    select(
        RESULTS,
        "select run_id, case when parameters like '{%' then y end as year, "
        "case when parameters like '{%' then '{\"contamination\":\"0.05\",\"year\":\"' || y || '\"}' end parameters_text, "
        "parameters original from (select *, substr(run_id, 5, 4) y from runs)",
    ),
)
def c15(spark, folder):
    parsed = both(spark, folder)[1].withColumn("map", S.parameters_map(F.col("parameters")))
    return parsed.select(
        "run_id",
        F.col("map")["year"].alias("year"),
        S.parameters_text(F.col("map")).alias("parameters_text"),
        F.col("parameters").alias("original"),
    )


@query(
    "j1_rows_with_runs",
    select(RESULTS, "select notice_id, run_id, is_outlier, model_type, execution_date from r join runs using (run_id)"),
)
def j1(spark, folder):
    joined = runs.rows_with_runs(*both(spark, folder))
    return joined.select("notice_id", "run_id", "is_outlier", "model_type", "execution_date")


@query(
    "j2_semi_anti",
    select(
        RESULTS,
        "select notice_id, 'expired' kind from r where run_id in (select run_id from runs where execution_date < '1996-06-15') "
        "union all select notice_id, 'kept' from r where run_id not in (select run_id from runs where execution_date < '1996-06-15')",
    ),
)
def j2(spark, folder):
    rows, metadata = both(spark, folder)
    expired = runs.expired_runs(metadata, 30, "1996-07-15").select("run_id")
    gone = rows.join(expired, "run_id", "left_semi").select("notice_id", F.lit("expired").alias("kind"))
    kept = runs.retained(rows, metadata, 30, "1996-07-15").select("notice_id", F.lit("kept").alias("kind"))
    return gone.unionAll(kept)


@query(
    "w4_topk",
    select(
        RESULTS,
        "select * from (select 'type' kind, notice_type name, count(*) n from r group by notice_type order by n desc, name limit 10) "
        "union all select * from (select 'country', country, count(*) n from r group by country order by n desc, country limit 10)",
    ),
)
def w4(spark, folder):
    raw = tables.notices(spark, folder)
    top = cleaning.top_values_of(raw, {"notice-type": "type", "organisation-country-buyer": "country"})
    return top.toDF("kind", "name", "n")


@query("entry_outliers_by_country", select(FLAGGED, _BY_COUNTRY))
def flagship(spark, folder):
    return a13(spark, folder)
