import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlens.functions.quantiles import exact_quantiles, sample_rows, values_at_ranks

PROBABILITIES = (0.0, 0.05, 0.3, 0.5, 0.95, 1.0)


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(1)
    spread = rng.lognormal(8, 3, 3000)
    return np.concatenate([spread, np.full(1500, 5000.0), np.full(40, spread.max() * 2), -spread[:200]])


@pytest.fixture(scope="module")
def table(spark, values):
    rows = [(float(v),) for v in values] + [(None,)] * 50
    return spark.createDataFrame(rows, "v double").repartition(5).cache()


@pytest.mark.parametrize("small", [1_000_000, 500, 20])
def test_matches_numpy(table, values, small):
    found = exact_quantiles(table, {p: (F.col("v"), p) for p in PROBABILITIES}, small)
    for p, value in found.items():
        assert value == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_groups_and_empty_columns(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 3.0), (False, 10.0)], "f boolean, v double")
    found = exact_quantiles(
        df,
        {
            "t": (F.when(F.col("f"), F.col("v")), 0.5),
            "f": (F.when(~F.col("f"), F.col("v")), 0.5),
            "none": (F.lit(None), 0.5),
        },
    )
    assert found == {"t": 2.0, "f": 10.0, "none": None}


def test_ranks_of_one_hot_value(spark):
    df = spark.createDataFrame([(float(v),) for v in [7] * 300 + list(range(10))], "v double")
    ordered = sorted([7] * 300 + list(range(10)))
    wanted = {("v", r): 310 for r in (0, 6, 7, 150, 307, 308, 309)}
    assert values_at_ranks(df, wanted, small=3) == {key: ordered[key[1]] for key in wanted}


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    a = {r.id for r in sample_rows(df, F.col("id"), 700).collect()}
    b = {r.id for r in sample_rows(df.repartition(7), F.col("id"), 700, heap_rows=10).collect()}
    assert len(a) == 700 and a == b
    assert sample_rows(df, F.col("id"), 9000, heap_rows=10).count() == 5000
    assert a != {r.id for r in sample_rows(df, F.col("id"), 700, seed=1).collect()}
