"""Queries of the subpackage against their SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import compare  # noqa: E402

from tenderlens.llm import catalog  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, name):
    assert name in compare.entry.oracle_sql()
    assert compare.compare(spark, compare.open_database(FOLDER), name, FOLDER) == []
