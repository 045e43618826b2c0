import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendframe.operators import health, intervals


@pytest.fixture(scope="module")
def rows(spark):
    generator = random.Random(3)
    data = [(i, "abc"[i % 3] if i % 7 else None, None if i % 11 == 0 else 100.0 * (i % 3) + generator.gauss(0, 1 + i % 3)) for i in range(3000)]
    data += [(5000, "lone", 7.0), (5001, "empty", None)]
    return spark.createDataFrame(data, "k long, g string, y double")


def test_means_leave_the_own_fold_out(rows):
    found = intervals.out_of_fold_means(rows, "k", ["g"], "y").toPandas()
    assert len(found) == 3002
    for r in found.sample(60, random_state=1).itertuples():
        same = found[found.g.isna()] if r.g is None or r.g != r.g else found[found.g == r.g]
        others = same if math.isnan(r.y) else same[same.fold != r.fold]
        every = found if math.isnan(r.y) else found[found.fold != r.fold]
        wanted = others.y.mean() if others.y.notna().any() else every.y.mean()
        assert r.predicted == pytest.approx(wanted, abs=1e-5)
    assert found.set_index("k").predicted[[5000, 5001]].notna().all()


def test_radii_and_coverage(rows):
    found = intervals.out_of_fold_means(rows, "k", ["g"], "y")
    bins = intervals.conformal_bins(found, "y", held=F.col("fold") == 0).orderBy("bin").collect()
    data = found.toPandas().dropna(subset=["y"])
    fitted = data[data.fold != 0]
    edges = sorted(set(np.quantile(fitted.predicted, [0.25, 0.5, 0.75])))
    for r in bins:
        inside = fitted[np.searchsorted(edges, fitted.predicted, side="left") == r["bin"]]
        errors = np.sort(np.abs(inside.y - inside.predicted).to_numpy())
        k = math.ceil((len(errors) + 1) * 0.9)
        assert r["rows"] == len(errors) and r["radius"] == (pytest.approx(errors[k - 1]) if k <= len(errors) else None)


def test_coverage_of_a_fold_that_was_kept_out(spark, rows):
    found = intervals.out_of_fold_means(rows, "k", ["g"], "y")
    one = intervals.conformal_bins(found, "y", bins=1, held=F.col("fold") == 0).first()
    assert abs(one["covered"] - 0.9) < 0.03
    # predictions that differ, errors that grow with them
    spread = spark.range(20_000).select(
        (F.rand(4) * 100).alias("predicted"), F.randn(5).alias("e"), (F.col("id") % 5 == 0).alias("held")
    )
    spread = spread.withColumn("y", F.col("predicted") + F.col("e") * (1 + F.col("predicted") / 20)).cache()
    bins = intervals.conformal_bins(spread, "y", held=F.col("held")).orderBy("bin").collect()
    assert all(abs(r["covered"] - 0.9) < 0.03 for r in bins)
    assert [r["radius"] for r in bins] == sorted(r["radius"] for r in bins)


def test_fills_have_intervals_and_given_values_none(rows):
    found = intervals.out_of_fold_means(rows, "k", ["g"], "y")
    filled = intervals.fill_with_intervals(found, "y", intervals.conformal_bins(found, "y"))
    assert filled.where("y is null").isEmpty() and filled.count() == 3002
    gaps = filled.join(rows.select("k", F.col("y").alias("given")), "k")
    assert gaps.where("given is not null and (lower is not null or y <> given)").isEmpty()
    assert gaps.where("given is null and not (lower < y and y < upper)").isEmpty()


def test_too_few_rows_have_no_finite_interval(spark):
    few = spark.createDataFrame([(i, float(i), 1.0) for i in range(4)], "k long, y double, predicted double")
    assert [r["radius"] for r in intervals.conformal_bins(few, "y", bins=1).collect()] == [None]
    none = intervals.conformal_bins(few.limit(0), "y", held=F.lit(True))
    assert [(r["rows"], r["radius"], r["held_rows"]) for r in none.collect()] == [(0, None, 0)]


def test_cumulative_sums_follow_the_recurrence(spark):
    generator = random.Random(1)
    values = {m: [generator.gauss(5 if i < 25 or m == "still" else 8, 1) for i in range(40)] for m in ("moved", "still")}
    data = [(f"{i:03}", m, v) for m, series in values.items() for i, v in enumerate(series)]
    data += [("900", "moved", None), ("001", "flat", 1.0), ("002", "flat", 1.0)]
    found = health.level_changes(spark.createDataFrame(data, "run string, metric string, value double")).toPandas()
    for metric, series in values.items():
        centre, sd = np.mean(series[:10]), np.std(series[:10], ddof=1)
        up = down = 0.0
        for r, v in zip(found[found.metric == metric].sort_values("run").itertuples(), series, strict=True):
            z = (v - centre) / sd
            up, down = max(0.0, up + z - 0.5), max(0.0, down - z - 0.5)
            assert (r.up, r.down) == (pytest.approx(up, abs=1e-9), pytest.approx(down, abs=1e-9))
            assert r.alarm == (up > 4 or down > 4)
    assert found[found.metric == "moved"].alarm.iloc[-1] and found[found.metric == "flat"].up.isna().all()
