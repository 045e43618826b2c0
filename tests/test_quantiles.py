import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mendframe.operators.profile import numeric_profile
from mendframe.operators.quantiles import exact_quantiles, order_statistics

PROBABILITIES = [0.0, 0.25, 0.5, 0.9]


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize(
    ("shape", "limit"), [("uniform", 10**6), ("heavy", 20), ("hot", 40), ("two", 10), ("nulls", 30), ("one", 10**6), ("far", 10), ("wide", 10)]
)
def test_quantiles_match_pandas_for_any_range_size(spark, shape, limit):
    rng = np.random.default_rng(3)
    values = {
        "uniform": list(rng.uniform(-5, 5, 800)),
        "heavy": list(rng.lognormal(3, 2, 700)),
        "hot": [7.0] * 400 + list(rng.integers(0, 20, 300)),
        "two": [1.0] * 333 + [2.0] * 334,
        "nulls": [None] * 50 + list(rng.normal(0, 1, 301)),
        "one": [4.5],
        "far": [1e300, -1e300, float("inf"), *rng.normal(0, 1e-3, 200)],
        "wide": [float(10**k) for k in range(-150, 150)],
    }[shape]
    expected = pd.Series(values, dtype="float64").dropna().quantile(PROBABILITIES).tolist()
    got = exact_quantiles(frame(spark, values).repartition(5), {"x": PROBABILITIES}, max_rows=limit)["x"]
    assert got == pytest.approx(expected, rel=1e-12)


def test_no_values_give_none(spark):
    assert exact_quantiles(frame(spark, [None, None]), {"x": [0.5]}) == {"x": [None]}


def test_order_statistics_of_large_whole_numbers(spark):
    keys = [2**60 + i * 3 for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(3)
    found = order_statistics(df, {"k": F.col("k")}, {"k": [0, 123, 499]}, {"k": 500}, max_rows=20)
    assert [found[("k", i)] for i in (0, 123, 499)] == [keys[0], keys[123], keys[499]]


def test_several_series_share_the_scans(spark):
    df = spark.createDataFrame([(i % 3, float(i)) for i in range(300)], "fold int, x double")
    series = {str(f): F.when(F.col("fold") != f, F.col("x")) for f in range(3)}
    got = exact_quantiles(df, {name: [0.5] for name in series}, series=series, max_rows=30)
    for f in range(3):
        kept = [float(i) for i in range(300) if i % 3 != f]
        assert got[str(f)] == [pd.Series(kept).median()]


def test_nan_infinities_and_extremes(spark):
    """NaN counts as missing, infinities rank outside, and spread-out magnitudes need no more scans."""
    nan, inf = float("nan"), float("inf")
    values = [nan, 1.0, 2.0, -inf, inf, inf, 1e-300, 1e300, None, nan, -1e-300, 5e-324] + [float(10**k) for k in range(300)]
    expected = pd.Series([v for v in values if v is not None and v == v]).quantile([0.0, 0.25, 0.5, 0.75, 1.0], interpolation="lower").tolist()
    got = exact_quantiles(frame(spark, values).repartition(3), {"x": [0.0, 0.25, 0.5, 0.75, 1.0]}, max_rows=5)["x"]
    assert got[0] == -inf and got[4] == inf
    assert all(a <= b for a, b in zip(expected[1:4], got[1:4], strict=True))
    assert exact_quantiles(frame(spark, [nan, 1.0, 2.0]), {"x": [0.5]}) == {"x": [1.5]}
    assert exact_quantiles(frame(spark, [nan, nan]), {"x": [0.5]}) == {"x": [None]}


def test_many_distinct_values_with_an_infinity(spark):
    df = spark.range(30_000).select(F.when(F.col("id") == 0, float("inf")).otherwise(F.exp(F.col("id") / 100)).alias("x"))
    got = exact_quantiles(df, {"x": [0.25, 0.5]}, max_rows=50)["x"]
    expected = df.toPandas()["x"].quantile([0.25, 0.5]).tolist()
    assert got == pytest.approx(expected, rel=1e-12)


def test_profile_leaves_no_files_and_reads_nan_as_missing(spark, tmp_path):
    from pathlib import Path

    from mendframe.session import shared_checkpoint_dir

    folder = Path(shared_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.rglob("numbers-*"))
    df = spark.createDataFrame([(float("nan"), "1e999"), (1.0, "2"), (3.0, "4")], "x double, t string")
    df = df.select("x", F.col("t").cast("double").alias("t"))
    rows = {r["column"]: r for r in numeric_profile(df).collect()}
    assert rows["x"]["count"] == 2 and rows["x"]["median"] == 2.0
    assert rows["t"]["median"] == 4.0 and rows["t"]["max"] == float("inf")
    assert set(folder.rglob("numbers-*")) == before
