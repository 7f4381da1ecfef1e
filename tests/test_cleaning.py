import math

import pytest

from tenderlens.functions import scalars as S
from tenderlens.operators import cleaning
from pyspark.sql import functions as F

RAW = [
    ("N123", "1,000.50", "EUR 1000", "small|medium", "DE", "Contract notice"),
    ("N124", "2000", "SEK 2000", "large", "SE", "Contract award"),
    ("N125", "invalid", "USD 3000", None, "FR", "Contract notice"),
]
COLUMNS = (
    "`notice-identifier` string, `total-value` string, `estimated-value-cur-proc` string, "
    "`winner-size` string, `organisation-country-buyer` string, `notice-type` string"
)


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, COLUMNS)


def test_normalise(raw):
    rows = {r["notice-identifier"]: r.asDict() for r in cleaning.normalise(raw).collect()}
    assert len(rows) == 3
    assert [rows[i]["currency"] for i in ("N123", "N124", "N125")] == ["EUR", "SEK", "EUR"]
    assert [rows[i]["total-value"] for i in ("N123", "N124", "N125")] == [None, 2000.0, None]
    assert rows["N124"]["total-value-eur"] == rows["N124"]["total-value-eur-capped"] == 174.0
    assert [rows[i]["is_outlier"] for i in ("N123", "N124", "N125")] == [False] * 3
    assert rows["N123"]["total-value-eur-log"] == 0.0
    assert math.isclose(rows["N124"]["total-value-eur-log"], 5.1647859739235145)
    assert [rows[i]["bidder-count"] for i in ("N123", "N124", "N125")] == [2, 1, 0]
    assert [rows[i]["primary-bidder-size"] for i in ("N123", "N124", "N125")] == ["small", "large", None]
    assert [rows[i]["bidder-size-numeric"] for i in ("N123", "N124", "N125")] == [2.0, 4.0, None]
    assert [rows[i]["notice_is_Contract notice"] for i in ("N123", "N124", "N125")] == [1, 0, 1]
    assert [rows[i]["notice_is_Contract award"] for i in ("N123", "N124", "N125")] == [0, 1, 0]


def test_learning_table(raw):
    table = cleaning.prepare_for_ml(cleaning.normalise(raw))
    assert table.columns == [
        "notice-identifier",
        "total-value-eur",
        "total-value-eur-capped",
        "total-value-eur-log",
        "bidder-count",
        "bidder-size-numeric",
        "notice_is_Contract notice",
        "notice_is_Contract award",
        "total-value",
    ]
    assert table.count() == 1


@pytest.mark.parametrize(
    "text, value",
    [("1,000.50", None), ("-5", 5.0), ("1e6", 16.0), ("EUR 12,5", 12.5), ("1.", 1.0), (".", None), ("", None), (None, None)],
)
def test_money(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(S.money(F.col("t"))).first()[0] == value


def test_numeric_money_loses_only_its_sign(spark):
    df = spark.createDataFrame([(-12500000.0,)], "`total-value` double")
    assert cleaning.parse_money(df).first()[0] == 12500000.0


@pytest.mark.parametrize(
    "value, label",
    [
        (0.4, "€0"), (2.5, "€2"), (999.0, "€999"), (1000.0, "€1.0K"), (1250.0, "€1.2K"), (1350.0, "€1.4K"), (1150.0, "€1.1K"),
        (999999.0, "€1000.0K"), (1e6, "€1.0M"), (2.45e9, "€2.5B"), (1.05e9, "€1.1B"), (None, None),
    ],
)
def test_currency_label(spark, value, label):
    df = spark.createDataFrame([(value,)], "v double")
    found = df.select(S.currency_label(F.col("v"))).first()[0]
    assert found == label
    if value is not None and value >= 1000:
        scale = next(s for s in (1e9, 1e6, 1e3) if value >= s)
        assert found[1:-1] == f"{value / scale:.1f}"


def test_types_that_differ_in_case_get_their_own_column(spark):
    df = spark.createDataFrame([("A",), ("A",), ("a",)], "`notice-type` string")
    out = cleaning.add_type_dummies(df)
    assert out.columns == ["notice-type", "notice_is_A", "notice_is_a_2"]
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0), (1, 0), (0, 1)]


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("x", "http://a")], "name string, `Link-URL` string")
    assert cleaning.normalise(df).columns == ["name", "currency"]
    assert cleaning.keep_valued(df).count() == 1


def test_table_without_values(spark):
    df = spark.createDataFrame([("none",), ("void",)], "`total-value` string")
    row = cleaning.normalise(df).first()
    assert row["total-value-eur-capped"] is None and row["is_outlier"] is False
