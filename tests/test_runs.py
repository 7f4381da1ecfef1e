import pytest

from tenderlens.operators import runs, summaries
from tenderlens.schema import RESULT_SCHEMA
from tenderlens.sources import csvfiles

ROWS = [
    ("N123", 1000.0, "DE", "Contract notice", False, 0.3),
    ("N124", 2000.0, "FR", "Award", True, 0.8),
    ("N125", 500.0, "IT", "Notice", False, 0.2),
]
SCHEMA = (
    "`notice-identifier` string, `total-value-eur` double, `organisation-country-buyer` string, `notice-type` string, "
    "is_outlier boolean, anomaly_score double"
)
CHART = [
    ("N123", 1000.0, "DE", "Contract notice", False, 0.3),
    ("N124", 2000.0, "FR", "Award", False, 0.4),
    ("N125", 50000.0, "DE", "Notice", True, 0.9),
    ("N126", 1500.0, "IT", "Award", False, 0.2),
]


@pytest.fixture
def store(spark, tmp_path):
    return runs.RunStore(spark, str(tmp_path / "store"))


def test_store_and_statistics(spark, store):
    assert store.runs.count() == 0 and store.rows.count() == 0
    run_id = store.store("isolation_forest", spark.createDataFrame(ROWS, SCHEMA), {"contamination": 0.05}, "first")
    assert store.runs.count() == 1 and store.rows.count() == 3
    stats = runs.overall_statistics(store.rows, store.runs).first()
    assert (stats.total_runs, stats.total_records, stats.total_outliers) == (1, 3, 1)
    assert stats.overall_outlier_percentage == pytest.approx(100 / 3)
    summary = runs.run_summary(store.rows, store.runs, run_id).first()
    assert summary.parameter_map == {"contamination": "0.05"}
    assert summary.outlier_stats.asDict() == {
        "total_outliers": 1, "avg_score": 0.8, "min_value": 2000.0, "max_value": 2000.0, "avg_value": 2000.0
    }
    assert [tuple(c) for c in summary.country_breakdown] == [("DE", 1, 0, 0.0), ("FR", 1, 1, 100.0), ("IT", 1, 0, 0.0)]
    assert runs.run_summary(store.rows, store.runs, "other").count() == 0
    assert [r.notice_id for r in runs.top_outliers(store.rows, run_id).collect()] == ["N124"]


def test_an_unfinished_run_is_invisible(spark, store):
    store.store("dbscan", spark.createDataFrame(ROWS, SCHEMA), run_id="whole")
    from pyspark.sql import functions as F

    torn = runs.result_rows(spark.createDataFrame(ROWS, SCHEMA), F.lit("torn"))
    torn.write.mode("append").partitionBy("run_id").parquet(store.rows_path)
    assert {r.run_id for r in store.rows.collect()} == {"whole"}


def test_rows_without_the_usual_columns(spark, store):
    df = spark.createDataFrame([("7",)], "identifier string")
    store.store("kmeans", df, run_id="bare")
    assert tuple(store.rows.first())[1:] == ("7", 0.0, "unknown", "unknown", 0, 0.0)


def test_retention(spark, store):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for day in ("2024-03-01", "2024-03-02", "2024-03-31"):
        store.store("kmeans", df, executed_at=f"{day} 08:00:00", run_id=day)
    assert store.remove_old(30, "2024-04-01") == 1
    assert sorted(r.run_id for r in store.runs.collect()) == ["2024-03-02", "2024-03-31"]
    assert store.rows.count() == 6
    assert store.remove_old(30, "2024-04-01") == 0
    assert [r.run_id for r in runs.recent_runs(store.runs, 1).collect()] == ["2024-03-31"]


def test_retention_that_breaks_off(spark, store, monkeypatch):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for day in ("2024-02-01", "2024-03-01", "2024-03-31"):
        store.store("kmeans", df, executed_at=f"{day} 08:00:00", run_id=day)
    done, whole = [], runs.RunStore._drop

    def drop(self, system, folder):
        if len(done) == 1:
            raise OSError("lost")
        done.append(folder)
        whole(self, system, folder)

    monkeypatch.setattr(runs.RunStore, "_drop", drop)
    with pytest.raises(OSError):
        store.remove_old(30, "2024-04-01")
    monkeypatch.undo()
    left = sorted(r.run_id for r in store.runs.collect())
    assert len(left) == 2 and left[-1] == "2024-03-31" and store.rows.count() == 6
    assert store.remove_old(30, "2024-04-01") == 1
    assert [r.run_id for r in store.runs.collect()] == ["2024-03-31"] and store.rows.count() == 3


def test_export(spark, store, tmp_path):
    run_id = store.store("kmeans", spark.createDataFrame(ROWS, SCHEMA))
    assert store.export_csv(run_id, str(tmp_path / "csv")) is True
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    assert store.export_csv("none", str(tmp_path / "empty")) is False
    assert not (tmp_path / "empty").exists()


def test_export_of_awkward_texts(spark, store, tmp_path):
    rows = [('a "b", c', 1.0, "D,E", "two\nlines", True, 0.5), ("#1", 2.0, '"', ",", False, 0.25), ("plain", 3.0, None, None, False, 0.0)]
    run_id = store.store("kmeans", spark.createDataFrame(rows, SCHEMA))
    assert store.export_csv(run_id, str(tmp_path / "csv")) is True
    back = csvfiles.read_csv(spark, str(tmp_path / "csv"), RESULT_SCHEMA)
    assert sorted(map(repr, back.select(store.rows.columns).collect())) == sorted(map(repr, store.rows.collect()))


@pytest.mark.parametrize("step", ["rows", "metadata", "move rows", "move metadata"])
def test_a_store_that_breaks_off_and_is_retried(spark, store, monkeypatch, step):
    df = spark.createDataFrame(ROWS, SCHEMA)
    whole, moved = runs.RunStore._move, []

    def move(self, system, source, target):
        moved.append(target)
        if step == ("move rows", "move metadata")[len(moved) - 1]:
            raise OSError("lost")
        whole(self, system, source, target)

    def lost(*args):
        raise OSError("lost")

    if step.startswith("move"):
        monkeypatch.setattr(runs.RunStore, "_move", move)
    else:
        monkeypatch.setattr(runs, "result_rows" if step == "rows" else "write_csv", lost)
        if step == "metadata":
            monkeypatch.setattr(runs.S, "stamp", lost)
    with pytest.raises(OSError):
        store.store("kmeans", df, run_id="a/b:c")
    monkeypatch.undo()
    assert store.rows.count() == 0 and store.runs.count() == 0
    for _ in range(2):
        assert store.store("kmeans", df, run_id="a/b:c") == "a/b:c"
        assert [(r.run_id, r.record_count) for r in store.runs.collect()] == [("a/b:c", 3)]
        assert sorted(r.notice_id for r in store.rows.collect()) == ["N123", "N124", "N125"]
        assert runs.rows_with_runs(store.rows, store.runs).count() == 3
    store.store("kmeans", df, executed_at="2024-01-01 08:00:00", run_id="d")
    assert store.remove_old(30, "2024-04-01") == 1 and store.rows.count() == 3


def test_empty_run(spark, store):
    run_id = store.store("kmeans", spark.createDataFrame([], SCHEMA))
    row = store.runs.first()
    assert (row.run_id, row.record_count, row.outlier_count, row.outlier_percentage) == (run_id, 0, 0, 0.0)


def test_chart_tables(spark):
    df = spark.createDataFrame(CHART, SCHEMA)
    panel = summaries.outlier_panel(df).first()
    assert (panel.normal_count, panel.outlier_count, panel.normal_percentage) == (3, 1, 75.0)
    assert (panel.normal_avg, panel.outlier_avg) == (1500.0, 50000.0)
    assert panel.value_ratio == pytest.approx(100 / 3)
    by_country = {r.country: (r["count"], r.outliers, r.percentage, r.overall_percentage) for r in summaries.outlier_percent_by_country(df).collect()}
    assert by_country == {"DE": (2, 1, 50.0, 25.0), "FR": (1, 0, 0.0, 25.0), "IT": (1, 0, 0.0, 25.0)}
    assert summaries.score_threshold(df).first()[0] == 0.9
    assert summaries.summary_statistics(df).first().median == 1750.0
    assert sum(r["count"] for r in summaries.log_histogram(df).collect()) == 4
    boxes = {r.status: r for r in summaries.box_statistics(df).collect()}
    assert (boxes["NORMAL"].median, boxes["NORMAL"].fliers) == (1500.0, 0)


def test_without_outliers_or_rows(spark):
    df = spark.createDataFrame(CHART[:2], SCHEMA)
    row = summaries.evaluation(df, "2024-01-01 00:00:00").first()
    assert row.outlier_percentage == 0.0 and row.value_statistics.outlier_avg_value == 0.0
    empty = spark.createDataFrame([], SCHEMA)
    assert summaries.outlier_share(empty).first().outlier_percentage == 0.0
    assert summaries.box_statistics(empty).count() == 0
    assert summaries.log_histogram(empty).count() == 0
