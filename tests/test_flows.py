import json

import pytest
from pyspark.sql import functions as F

from tenderlens.operators import runs
from tenderlens.plans import flows

AS_OF = "2024-05-31 00:00:00"


@pytest.fixture(scope="module")
def pages_path(tmp_path_factory):
    folder = tmp_path_factory.mktemp("pages")
    for number in range(3):
        notices = [
            {
                "notice-identifier": f"N{number}-{i}",
                "publication-date": "2024-05-20" if i else "2024-01-01",
                "total-value": f"{(i + 1) * 1000 * (50 if i == 19 else 1)}.00",
                "estimated-value-cur-proc": "EUR 1000",
                "winner-size": ["small", "large"],
                "notice-type": ["cn-standard", "pin-only"][i % 2],
                "organisation-country-buyer": "DE" if i % 3 else "FR",
                "links": {"pdf": "http://x"},
            }
            for i in range(20)
        ]
        (folder / f"p{number}.json").write_text(json.dumps({"notices": notices}))
    return str(folder)


def test_from_pages_to_report(spark, pages_path, tmp_path):
    out = flows.ingest(spark, pages_path, str(tmp_path / "data"), as_of=AS_OF)
    table = spark.read.option("header", True).option("inferSchema", True).csv(out["ml_dataset"])
    assert table.count() == 57 and out["ml_dataset"].endswith("ml_dataset_20240531_000000")
    assert spark.read.option("header", True).csv(out["raw"]).count() == 57
    key = "notice-identifier"
    store = runs.RunStore(spark, str(tmp_path / "store"))
    model = str(tmp_path / "model")
    scored = flows.detect_with_forest(table, key, model, store, training=table, csv_path=str(tmp_path / "scored"), as_of=AS_OF)
    assert scored.count() == 57 and scored.filter("is_outlier").count() >= 1
    assert scored.filter("outlier_status = 'OUTLIER'").count() == scored.filter("is_outlier").count()
    metrics = flows.evaluate_forest(table, model, str(tmp_path / "metrics"), AS_OF).first()
    assert metrics.total_records == 57 and metrics.value_statistics.value_ratio > 1
    report = flows.write_report(store, str(tmp_path / "report"), days=30, as_of=AS_OF).first()
    assert report.record_count == 57 and report.data_period == "30 days"
    assert spark.read.json(str(tmp_path / "report")).count() == 1
    with pytest.raises(ValueError):
        flows.write_report(store, str(tmp_path / "late"), days=1, as_of="2025-05-31 00:00:00")


@pytest.mark.parametrize("method", ["dbscan", "kmeans"])
def test_cluster_runs(spark, pages_path, tmp_path, method):
    table = flows.ingest(spark, pages_path, str(tmp_path / "data"), as_of=AS_OF, country="DE", max_value=20000)["ml_df"]
    assert table.count() == 36
    store = runs.RunStore(spark, str(tmp_path / "store"))
    found = flows.cluster_run(table, "notice-identifier", method, n_clusters=3, csv_path=str(tmp_path / "out"), store=store)
    assert found.count() == 36 and store.rows.count() == 36
    assert found.agg(F.max("anomaly_score")).first()[0] == 1.0
    path = flows.train_clustering(table, "notice-identifier", str(tmp_path / "model"), method, eps=None, n_clusters=3)
    labelled = flows.detect_with_clustering(table, "notice-identifier", path, AS_OF)
    assert labelled.count() == 36 and {"cluster", "outlier_status", "prediction_time"} <= set(labelled.columns)
    record = flows.evaluate_clustering(table, "notice-identifier", path).first()
    assert -1 <= record.silhouette_score <= 1


def test_unknown_method(spark):
    df = spark.createDataFrame([(1, 2.0)], "k bigint, v double")
    with pytest.raises(ValueError):
        flows.cluster_run(df, "k", "optics")


def test_cluster_run_keeps_rows_of_null_and_repeated_ids(spark):
    rows = [(None if i % 10 == 0 else f"n{i % 70}", float(i % 7), float(i * i % 40)) for i in range(100)]
    df = spark.createDataFrame(rows, "`notice-identifier` string, value double, bidders double")
    found = flows.cluster_run(df, "notice-identifier", "dbscan", eps=0.1, min_samples=3)
    assert found.count() == 100 and set(found.columns) == {*df.columns, "cluster", "is_outlier", "anomaly_score"}
    wanted = {}
    for row in found.collect():
        wanted.setdefault((row.value, row.bidders), set()).add((row.cluster, row.anomaly_score and round(row.anomaly_score, 9)))
    assert all(len(v) == 1 for v in wanted.values())


def test_report_counts_all_rows(spark, tmp_path):
    from tenderlens.operators.runs import RunStore

    df = spark.range(25_000).selectExpr("cast(id as string) notice_id", "1.0D value_eur", "id % 10 = 0 is_outlier", "0.5D anomaly_score")
    store = RunStore(spark, str(tmp_path / "store"))
    store.store("isolation_forest", df)
    row = flows.write_report(store, str(tmp_path / "report")).first()
    assert row.record_count == 25_000 and row.outlier_count == 2_500
    plain = flows.write_report(store, str(tmp_path / "plain"), df=df.drop("is_outlier")).first()
    assert plain.record_count == 25_000 and "outlier_count" not in plain.asDict()
