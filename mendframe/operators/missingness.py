"""Test of the missing-data mechanism: are values of several numeric columns missing completely at random?

Rows group by which columns they lack. Per pattern one aggregate keeps the rows, sums and cross products of what
is present; expectation maximisation of a normal model needs nothing else, so it runs on these few numbers
however many rows there are. The statistic weighs how far the means of the patterns lie from the common mean.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendframe.functions.columns import quoted

#: Columns at most: the patterns on the driver are no more than 2^12, whatever the rows.
MOST_COLUMNS = 12
ROUNDS = 2000
TOLERANCE = 1e-11

Pattern = tuple[tuple[int, ...], int, np.ndarray, np.ndarray]


def pattern_sums(df: DataFrame, columns: Sequence[str]) -> tuple[list[Pattern], np.ndarray, np.ndarray]:
    """Present columns, rows, sums and cross products of every pattern, with the centre and scale they are taken in.

    Rows without any value tell nothing of the mean and are left out. NaN counts as null. Values are centred
    and scaled by the moments of each column first: products of large values would lose their digits.
    """
    if not 1 <= len(columns) <= MOST_COLUMNS or len(set(columns)) < len(columns):
        raise ValueError(f"takes 1 to {MOST_COLUMNS} different columns")
    x = [F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double")) for c in columns]
    rows = df.select(*[v.alias(f"x{i}") for i, v in enumerate(x)])
    moments = rows.agg(*[m(f"x{i}") for i in range(len(x)) for m in (F.avg, F.stddev_pop)]).first()
    centre = np.array([moments[2 * i] or 0.0 for i in range(len(x))])
    scale = np.array([moments[2 * i + 1] or 1.0 for i in range(len(x))])
    z = [(F.col(f"x{i}") - F.lit(float(centre[i]))) / F.lit(float(scale[i])) for i in range(len(x))]
    mask = sum((F.when(F.col(f"x{i}").isNotNull(), 1 << i).otherwise(0) for i in range(len(x))), F.lit(0))
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    grouped = rows.groupBy(mask.alias("mask")).agg(
        F.count("*").alias("n"),
        *[F.sum(z[i]).alias(f"s{i}") for i in range(len(x))],
        *[F.sum(z[i] * z[j]).alias(f"p{i}_{j}") for i, j in pairs],
    )
    patterns = []
    for r in sorted(grouped.filter("mask > 0").collect(), key=lambda r: r["mask"]):
        seen = tuple(i for i in range(len(x)) if r["mask"] >> i & 1)
        products = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in seen] for i in seen], dtype=float)
        patterns.append((seen, r["n"], np.array([r[f"s{i}"] for i in seen], dtype=float), products))
    return patterns, centre, scale


def normal_likelihood(patterns: Sequence[Pattern], width: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, bool]:
    """Mean and covariance of the most likely normal distribution, and whether the iteration settled."""
    total = sum(n for _, n, _, _ in patterns)
    mean, cov = np.zeros(width), np.eye(width)
    for _ in range(rounds):
        first, second = np.zeros(width), np.zeros((width, width))
        for seen, n, sums, products in patterns:
            o, m = list(seen), [i for i in range(width) if i not in seen]
            slope = cov[np.ix_(m, o)] @ np.linalg.pinv(cov[np.ix_(o, o)], hermitian=True)
            base = mean[m] - slope @ mean[o]
            first[o] += sums
            first[m] += n * base + slope @ sums
            cross = np.outer(base, sums) + slope @ products
            second[np.ix_(o, o)] += products
            second[np.ix_(m, o)] += cross
            second[np.ix_(o, m)] += cross.T
            rest = cov[np.ix_(m, m)] - slope @ cov[np.ix_(o, m)]
            lean = np.outer(base, slope @ sums)
            second[np.ix_(m, m)] += n * (rest + np.outer(base, base)) + lean + lean.T + slope @ products @ slope.T
        new_mean = first / total
        new_cov = second / total - np.outer(new_mean, new_mean)
        moved = max(np.abs(new_mean - mean).max(), np.abs(new_cov - cov).max())
        mean, cov = new_mean, new_cov
        if moved < TOLERANCE:
            return mean, cov, True
    return mean, cov, False


def missing_at_random(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: `rows` with a value, `patterns`, `statistic`, `degrees`, `p_value`, `settled`.

    A small `p_value` speaks against values missing completely at random. One pattern alone has no degrees and
    a null p-value; without rows the statistic is null as well. Columns that depend on each other linearly, or
    are constant, enter by the pseudo-inverse and still count in the degrees.
    """
    patterns, _, _ = pattern_sums(df, columns)
    schema = "rows bigint, patterns int, statistic double, degrees int, p_value double, settled boolean"
    if not patterns:
        return df.sparkSession.createDataFrame([(0, 0, None, 0, None, True)], schema)
    used = sorted({i for seen, *_ in patterns for i in seen})  # a column without values takes no part
    place = {c: i for i, c in enumerate(used)}
    patterns = [(tuple(place[i] for i in seen), n, s, p) for seen, n, s, p in patterns]
    mean, cov, settled = normal_likelihood(patterns, len(used))
    statistic = 0.0
    for seen, n, sums, _ in patterns:
        o = list(seen)
        gap = sums / n - mean[o]
        statistic += n * float(gap @ np.linalg.pinv(cov[np.ix_(o, o)], hermitian=True) @ gap)
    degrees = sum(len(seen) for seen, *_ in patterns) - len(used)
    p_value = upper_chi_square(statistic, degrees) if degrees else None
    row = (sum(n for _, n, _, _ in patterns), len(patterns), statistic, degrees, p_value, settled)
    return df.sparkSession.createDataFrame([row], schema)


def upper_chi_square(value: float, degrees: int) -> float:
    """Chance that a chi-square variable exceeds the value: a finite sum that starts from one or two degrees."""
    if value <= 0:
        return 1.0
    half = value / 2
    if degrees % 2:
        chance, term = math.erfc(math.sqrt(half)), math.log(half) / 2 - half - math.lgamma(1.5)
        k = 1.5
    else:
        chance, term = math.exp(-half), math.log(half) - half
        k = 2.0
    for _ in range((degrees - 1) // 2):
        chance += math.exp(term)
        term += math.log(half) - math.log(k)
        k += 1
    return min(chance, 1.0)
