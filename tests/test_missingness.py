import numpy as np
import pandas as pd
import pytest

from mendframe.operators import missingness as mm


def rows_em(x, rounds=600):
    """The same test row by row: every row's own regression of what it lacks."""
    x = x[~np.isnan(x).all(axis=1)]
    n, p = x.shape
    mean, cov = np.nanmean(x, axis=0), np.diag(np.nanvar(x, axis=0))
    for _ in range(rounds):
        filled, extra = np.empty_like(x), np.zeros((p, p))
        for r in range(n):
            m = np.isnan(x[r])
            filled[r] = x[r]
            if m.any():
                slope = np.linalg.solve(cov[np.ix_(~m, ~m)], cov[np.ix_(~m, m)]).T
                filled[r, m] = mean[m] + slope @ (x[r, ~m] - mean[~m])
                extra[np.ix_(m, m)] += cov[np.ix_(m, m)] - slope @ cov[np.ix_(~m, m)]
        mean = filled.mean(axis=0)
        cov = (filled - mean).T @ (filled - mean) / n + extra / n
    statistic, degrees = 0.0, -p
    for key in {tuple(np.isnan(r)) for r in x}:
        o = ~np.array(key)
        part = x[(np.isnan(x) == np.array(key)).all(axis=1)][:, o]
        gap = part.mean(axis=0) - mean[o]
        statistic += len(part) * gap @ np.linalg.solve(cov[np.ix_(o, o)], gap)
        degrees += o.sum()
    return statistic, degrees


def gapped(seed, dependent):
    rng = np.random.default_rng(seed)
    x = rng.multivariate_normal([1e5, -3, 0.5], [[4e6, 900, 300], [900, 1, 0.2], [300, 0.2, 0.5]], 300)
    gone = rng.uniform(size=x.shape) < 0.2
    if dependent:
        gone[:, 1] = x[:, 0] > 1.01e5
    x[gone] = np.nan
    return x


def frame(spark, x):
    return spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c d"])).repartition(5)


@pytest.mark.parametrize("dependent", [False, True])
def test_equals_row_by_row(spark, dependent):
    x = gapped(11, dependent)
    found = mm.missing_at_random(frame(spark, x), ["a", "b", "c d"]).first()
    statistic, degrees = rows_em(x)
    assert found["statistic"] == pytest.approx(statistic, rel=1e-6) and found["degrees"] == degrees and found["settled"]
    assert found["rows"] == (~np.isnan(x).all(axis=1)).sum()
    assert found["p_value"] < 1e-6 if dependent else found["p_value"] > 0.01


def test_p_values():
    # fixed values: upper 5 % and 1 % points of the distribution
    for degrees, value, chance in ((1, 3.841458820694124, 0.05), (2, 5.991464547107979, 0.05), (5, 15.08627246938899, 0.01),
                                   (10, 18.307038053275146, 0.05), (30, 50.89218131151707, 0.01)):
        assert mm.upper_chi_square(value, degrees) == pytest.approx(chance, rel=1e-9)
    assert mm.upper_chi_square(0.0, 3) == 1.0 and mm.upper_chi_square(5000.0, 7) == pytest.approx(0.0, abs=1e-300)


def test_odd_tables(spark):
    schema = "a double, b double, e double"
    whole = spark.createDataFrame([(1.0, 2.0, None), (2.0, 1.0, None), (3.0, 5.0, None), (None, None, None)], schema)
    got = mm.missing_at_random(whole, ["a", "b", "e"]).first()
    assert (got["rows"], got["patterns"], got["degrees"], got["p_value"]) == (3, 1, 0, None)
    assert got["statistic"] == pytest.approx(0, abs=1e-12)
    none = mm.missing_at_random(whole.limit(0), ["a", "b"]).first()
    assert (none["rows"], none["patterns"], none["statistic"]) == (0, 0, None)
    constant = spark.createDataFrame([(1.0, 4.0, None), (2.0, 4.0, None), (6.0, None, None)], schema)
    assert np.isfinite(mm.missing_at_random(constant, ["a", "b"]).first()["statistic"])
    for columns in ([], ["a", "a"], [f"c{i}" for i in range(13)]):
        with pytest.raises(ValueError):
            mm.missing_at_random(whole, columns)
