"""What the plans must look like."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["c2_money", "c4_cap", "a13_outlier_pct_country", "p10_result_rows", "m6_assign", "f7_matrix"])
def test_stays_in_the_jvm_without_cross_products(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "Python" not in text and "CartesianProduct" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(entry.queries()["c5_flag"](spark, FOLDER))
    assert "o_orderdate" not in text and "c_acctbal" not in text and "n_name" not in text


def test_search_is_pushed_down(spark):
    text = plan(entry.queries()["p1_search_filter"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in text and "EqualTo(n_name,NATION_7)" in text


def test_pages_are_top_k(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["p4_page"](spark, FOLDER))
