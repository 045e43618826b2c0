import numpy as np
import pytest
from pyspark.sql import functions as F

from mendframe.operators import profile as profiles
from mendframe.operators import sketches

EXACT = ["rows", "nulls", "zeros", "low", "high"]


@pytest.fixture(scope="module")
def readings(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(20_000):
        hot = i % 3 == 0  # a third of all rows in one day, with one value half of the time
        value = None if i % 50 == 0 else (0.0 if hot and i % 2 else float(np.exp(rng.normal())))
        rows.append((f"d{0 if hot else i % 17}", "ab"[i % 2], value, i % 700))
    return spark.createDataFrame(rows, "day string, kind string, value double, code int")


def test_merged_equals_one_pass_on_exact_parts_and_bounds(spark, readings):
    by_day = sketches.sketch_columns(readings, F.col("day"), ["value", "code"], ["kind"])
    merged = sketches.merge_sketches(by_day)
    once = sketches.sketch_columns(readings, F.lit("all"), ["value", "code"])
    assert {tuple(r) for r in merged.select("column", *EXACT).collect()} == {tuple(r) for r in once.select("column", *EXACT).collect()}
    sums = lambda df: {r["column"]: (r["total"], r["squares"]) for r in df.collect()}
    for c, pair in sums(merged).items():
        assert pair == pytest.approx(sums(once)[c])
    profile = sketches.sketch_profile(merged)
    for c, distinct in (("value", readings.select("value").distinct().count() - 1), ("code", 700)):
        errors = sketches.rank_errors(readings, profile, c).collect()
        assert len(errors) == 3 and all(r["error"] <= sketches.RANK_ERROR for r in errors)
        found = profile.filter(F.col("column") == c).first()
        assert abs(found["distinct"] - distinct) <= sketches.DISTINCT_ERROR * distinct
        plain = readings.agg(F.avg(c), F.stddev(c)).first()
        assert (found["mean"], found["std"]) == (pytest.approx(plain[0]), pytest.approx(plain[1]))
    # merging in two steps, kinds first, holds the same bounds
    steps = sketches.merge_sketches(sketches.merge_sketches(by_day, ["kind"]))
    assert all(r["error"] <= sketches.RANK_ERROR for r in sketches.rank_errors(readings, sketches.sketch_profile(steps), "value").collect())


def test_only_new_periods_are_added(spark, readings, tmp_path):
    path = str(tmp_path / "s")
    first = readings.filter("day IN ('d1', 'd2')")
    assert sketches.add_periods(spark, path, first, F.col("day"), ["value"]) == 2
    assert sketches.add_periods(spark, path, readings, F.col("day"), ["value"]) == 15
    assert sketches.add_periods(spark, path, readings, F.col("day"), ["value"]) == 0
    stored = sketches.merge_sketches(spark.read.parquet(path)).first()
    assert stored["rows"] == readings.count() and stored["nulls"] == readings.filter("value IS NULL").count()


def test_nulls_nan_signed_zero_and_no_rows(spark):
    rows = [(None, None), (None, float("nan")), ("a", -0.0), ("a", 0.0), ("a", 5.0)]
    df = spark.createDataFrame(rows, "period string, x double").withColumnRenamed("period", "p")
    made = sketches.sketch_columns(df, F.col("p"), ["x"])
    got = {r["period"]: r for r in sketches.sketch_profile(sketches.merge_sketches(made, ["period"])).collect()}
    assert got[None]["rows"] == got[None]["nulls"] == 2 and got[None]["distinct"] == 0
    assert [got[None][c] for c in ("min", "max", "mean", "std", "q50")] == [None] * 5
    assert (got["a"]["zeros"], got["a"]["distinct"], got["a"]["q50"]) == (2, 2, 0.0)
    assert sketches.sketch_columns(df.limit(0), F.col("p"), ["x"]).count() == 0
    assert sketches.sketch_profile(sketches.merge_sketches(made.limit(0))).count() == 0
    assert made.schema.names == sketches.sketch_schema(df, ()).names
    with pytest.raises(ValueError):
        sketches.sketch_columns(df.withColumnRenamed("p", "rows"), F.lit(1), ["x"], ["rows"])


def test_wrong_answers_are_seen(spark, readings):
    """The check itself: a quantile that is off by far has a large error."""
    profile = sketches.sketch_profile(sketches.merge_sketches(sketches.sketch_columns(readings, F.col("day"), ["code"])))
    moved = profile.withColumn("q50", F.col("q50") + 100)
    errors = {r["rank"]: r["error"] for r in sketches.rank_errors(readings, moved, "code").collect()}
    assert errors[0.5] > 0.1 and errors[0.25] <= sketches.RANK_ERROR


def test_approximate_profile(spark, readings):
    """Exact measures stay; quartiles lie within the rank error; a column without values is left out as before."""
    df = readings.withColumn("none", F.lit(None).cast("double"))
    exact = {r["column"]: r for r in profiles.numeric_profile(df).collect()}
    found = {r["column"]: r for r in profiles.numeric_profile(df, approximate=True).collect()}
    assert set(found) == set(exact) == {"value", "code"}
    for c, row in found.items():
        assert all(row[m] == exact[c][m] for m in ("count", "min", "max", "zeros", "negatives"))
        named = spark.createDataFrame([(c, row["q25"], row["median"], row["q75"])], "column string, q25 double, q50 double, q75 double")
        assert all(r["error"] <= sketches.RANK_ERROR for r in sketches.rank_errors(df, named, c).collect())
        assert abs(row["outliers_percent"] - exact[c]["outliers_percent"]) < 3
    assert sketches.sketched_quantiles(df, {"none": (0.5,)}) == {"none": (None,)} and sketches.sketched_quantiles(df, {}) == {}
