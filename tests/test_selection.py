import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.operators.selection import exact_quantiles, newest, order_statistics

FRACTIONS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("options", [{}, {"accuracy": 20, "max_distinct": 5}, {"accuracy": 50, "max_distinct": 40}])
def test_quantiles_equal_numpy(spark, options):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(0, 3, 3000), 2).tolist()
    _, got = exact_quantiles(frame(spark, values), ["x"], FRACTIONS, **options)
    assert got["x"] == pytest.approx(np.quantile(values, FRACTIONS).tolist(), rel=1e-12)


def test_one_value_holds_most_rows(spark):
    values = [5.0] * 2000 + np.linspace(0, 10, 501).tolist()
    counts, got = exact_quantiles(frame(spark, values), ["x"], FRACTIONS, accuracy=10, max_distinct=3)
    assert counts["x"] == len(values)
    assert got["x"] == pytest.approx(np.quantile(values, FRACTIONS).tolist(), rel=1e-12)


def test_null_nan_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    counts, got = exact_quantiles(df, ["x"], [0.5])
    assert counts["x"] == 2 and got["x"] == [2.0]
    counts, got = exact_quantiles(df.where("false"), ["x"], [0.5])
    assert counts["x"] == 0 and got["x"] == [None]


def test_infinite_values(spark):
    values = [float("-inf"), 1.0, 2.0, 3.0, float("inf")]
    _, at = order_statistics(frame(spark, values), {"x": F.col("x")}, [0.5], lambda n, f: range(n))
    assert [at["x"][r] for r in range(5)] == values


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60))
def test_every_rank(spark, values):
    _, at = order_statistics(
        frame(spark, [float(v) for v in values]), {"x": F.col("x")}, [0.5], lambda n, f: range(n),
        accuracy=4, max_distinct=2,
    )
    assert [at["x"][r] for r in range(len(values))] == sorted(values)


def test_newest_equals_sort(spark):
    df = spark.range(5000).select("id", F.timestamp_seconds(F.col("id") % 700).alias("ts"))
    got = [r["id"] for r in newest(df, "ts", 100, "id").collect()]
    want = sorted(range(5000), key=lambda i: (-(i % 700), -i))[:100]
    assert sorted(got) == sorted(want)
    assert newest(df, "ts", 10_000, "id").count() == 5000
    stamped = df.withColumn("ts", F.lit("2024-01-01").cast("timestamp")).repartition(5)
    first = sorted(r["id"] for r in newest(stamped, "ts", 100).collect())
    again = sorted(r["id"] for r in newest(stamped.repartition(3), "ts", 100).collect())
    assert first == again and len(first) == 100 and max(first) - min(first) > 2500  # not the rows of one partition
