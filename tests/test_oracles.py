"""Every registered query with SQL agrees with DuckDB; the others give rows."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
ENTRY = compare.entry


@pytest.fixture(scope="module")
def database():
    return compare.open_database(FOLDER)


@pytest.mark.parametrize("name", sorted(ENTRY.oracle_sql()))
def test_against_sql(spark, database, name):
    assert compare.compare(spark, database, name, FOLDER) == []


@pytest.mark.parametrize("name", sorted(set(ENTRY.queries()) - set(ENTRY.oracle_sql())))
def test_gives_rows(spark, name):
    assert ENTRY.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert ENTRY.entry(spark).count() == 10
