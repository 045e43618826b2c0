"""Prediction intervals of numeric fills: split-conformal radii from out-of-fold residuals, binned by prediction.

The predictor is the mean of a group over the other folds, so a residual never comes from a mean that
holds its own row. Within a bin of predictions the radius is the order statistic of the absolute
residuals that covers a new row with probability `level`, whatever their distribution. Everything the
driver sees is a number for each bin or edge.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendframe import fixed_values as fixed
from mendframe.functions.columns import quoted
from mendframe.operators.quantiles import exact_quantiles, order_statistics
from mendframe.operators.splits import add_fold

LEVEL = 0.9
BINS = 4


def out_of_fold_means(
    df: DataFrame,
    key: str,
    group: Sequence[str],
    target: str,
    folds: int = fixed.FOLDS,
    seed: int | str = fixed.SEED,
    name: str = "predicted",
    digits: int = 6,
) -> DataFrame:
    """`df` with the fold of each row and `name`: the mean target of the row's group over the other folds.

    A row without target gets the mean of its whole group. Where the group has no other row with a
    target, the mean of all groups (without the row's fold) takes its place; null groups are groups.
    Groups are summed per fold before they meet the rows, so a hot group costs one row a fold.
    """
    rows = add_fold(df, key, folds, seed, "fold")
    side = F.when(quoted(target).isNull(), F.lit(-1)).otherwise(F.col("fold")).alias("_fold")
    parts = rows.groupBy(*[quoted(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("fold").alias("_fold")).agg(
        F.sum(target).alias("_s"), F.count(target).alias("_n")
    )
    names = [f"_g{i}" for i in range(len(group))]
    total = parts.groupBy(*names).agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"), F.collect_list(F.struct("_fold", "_s", "_n")).alias("_parts"))
    # at most one entry a fold: the rows of a group and, under -1, the whole of it
    own = F.concat("_parts", F.array(F.struct(F.lit(-1).alias("_fold"), F.lit(0.0).alias("_s"), F.lit(0).cast("long").alias("_n"))))
    means = total.select(*names, "_ts", "_tn", F.inline(own))
    means = means.select(*names, "_fold", _mean(F.col("_ts") - F.coalesce("_s", F.lit(0.0)), F.col("_tn") - F.col("_n")).alias("_mean"))
    every = parts.groupBy("_fold").agg(F.sum("_s").alias("s"), F.sum("_n").alias("n")).collect()
    s, n = math.fsum(r["s"] or 0.0 for r in every), sum(r["n"] for r in every)
    rest = {-1: (s, n)} | {r["_fold"]: (s - (r["s"] or 0.0), n - r["n"]) for r in every}
    fallback = F.lit(None).cast("double")
    for fold, (rs, rn) in rest.items():
        fallback = F.when(F.col("_fold") == fold, F.lit(rs / rn if rn else None).cast("double")).otherwise(fallback)
    alike = F.col("_fold") == F.col("_side")
    for i, g in enumerate(group):
        alike = alike & quoted(g).eqNullSafe(F.col(f"_g{i}"))
    joined = rows.withColumn("_side", side).join(means, alike, "left").withColumn("_fold", F.col("_side"))
    return joined.select(*[quoted(c) for c in df.columns], "fold", F.round(F.coalesce("_mean", fallback), digits).alias(name))


def _mean(total: Column, count: Column) -> Column:
    return F.when(count > 0, total / count)


def bin_of(predicted: Column, edges: Sequence[float]) -> Column:
    """Number of edges below a prediction."""
    return sum(((predicted > F.lit(e)).cast("int") for e in edges), F.lit(0))


def conformal_bins(
    df: DataFrame, target: str, predicted: str = "predicted", level: float = LEVEL, bins: int = BINS, held: Column | None = None
) -> DataFrame:
    """One row per bin of predictions: bin, low, high, rows, radius, held_rows, covered.

    Rows without target do not count. `held` marks rows that are kept out of edges and radii; covered is
    the share of them within the radius. radius is NULL (no finite interval) where a bin has too few rows
    for the level. A predictor with few distinct values wants `bins=1`: an edge among the predictions of one
    group, which differ a little from fold to fold, would part rows that belong together. Edges are quantiles of the predictions; low and high are NULL at the outer ends.
    """
    spark = df.sparkSession
    out_ = held if held is not None else F.lit(False)
    rows = df.where(quoted(target).isNotNull() & quoted(predicted).isNotNull())
    rows = rows.select(quoted(predicted).alias("p"), F.abs(quoted(target) - quoted(predicted)).alias("r"), out_.alias("held"))
    fitted = rows.where("not held")
    edges = exact_quantiles(fitted, {"p": [i / bins for i in range(1, bins)]})["p"]
    edges = sorted({e for e in edges if e is not None})
    fitted, number = fitted.withColumn("bin", bin_of(F.col("p"), edges)), len(edges) + 1
    sizes = {r["bin"]: r["n"] for r in fitted.groupBy("bin").agg(F.count("*").alias("n")).collect()}
    ranks = {str(b): [math.ceil((n + 1) * level) - 1] for b, n in sizes.items() if math.ceil((n + 1) * level) <= n}
    series = {name: F.when(F.col("bin") == int(name), F.col("r")) for name in ranks}
    at = order_statistics(fitted, series, ranks, {name: sizes[int(name)] for name in ranks}) if ranks else {}
    radii = [at.get((str(b), ranks[str(b)][0])) if str(b) in ranks else None for b in range(number)]
    out = [(b, edges[b - 1] if b else None, edges[b] if b < len(edges) else None, sizes.get(b, 0), radii[b]) for b in range(number)]
    table = spark.createDataFrame(out, "bin int, low double, high double, rows long, radius double")
    tested = rows.where("held").withColumn("bin", bin_of(F.col("p"), edges))
    within = F.when(radius_of(F.col("bin"), radii).isNull(), F.lit(1.0)).otherwise((F.col("r") <= radius_of(F.col("bin"), radii)).cast("double"))
    tested = tested.groupBy("bin").agg(F.count("*").alias("held_rows"), F.avg(within).alias("covered"))
    return table.join(tested, "bin", "left").fillna(0, ["held_rows"])


def radius_of(bin_: Column, radii: Sequence[float | None]) -> Column:
    return F.get(F.array(*[F.lit(r).cast("double") for r in radii]), bin_)


def fill_with_intervals(df: DataFrame, target: str, table: DataFrame, predicted: str = "predicted") -> DataFrame:
    """`df` with the gaps of `target` filled by the prediction and the interval of each fill: lower, upper (NULL for given values).

    `table` comes from `conformal_bins`: a row per bin.
    """
    bins = table.orderBy("bin").collect()
    edges = [r["low"] for r in bins if r["low"] is not None]
    radius = radius_of(bin_of(quoted(predicted), edges), [r["radius"] for r in bins])
    gap = quoted(target).isNull()
    kept = [quoted(c) for c in df.columns if c != target]
    return df.select(
        *kept,
        F.coalesce(quoted(target), quoted(predicted)).alias(target),
        F.when(gap, quoted(predicted) - radius).alias("lower"),
        F.when(gap, quoted(predicted) + radius).alias("upper"),
    )
