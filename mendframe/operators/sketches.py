"""Stored sketches per period: quantiles and distinct counts of any span by merging, without a second scan.

One row per period and column holds the exact counts, extremes and sums next to a quantile sketch (KLL) and
a distinct sketch (HyperLogLog), some tens of KB whatever the rows. Rows merge in any order and grouping:
the counts stay exact, sketches keep their error bounds. New periods are added to a stored table alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.functions.columns import quoted
from mendframe.functions.numeric import percent

#: Size of the quantile sketches: a rank is off by less than 1 % of the rows with 99 % confidence at 400.
KLL_SIZE = 400
#: Log2 of the registers of a distinct sketch: a relative standard error of about 0.8 % at 14.
HLL_BITS = 14
#: Bounds that the answers are held to in checks: several standard errors.
RANK_ERROR, DISTINCT_ERROR = 0.015, 0.04


def sketch_columns(
    df: DataFrame, period: Column, columns: Sequence[str], by: Sequence[str] = (), size: int = KLL_SIZE, bits: int = HLL_BITS
) -> DataFrame:
    """One row per period, group of `by` and column: `rows, nulls, zeros, low, high, total, squares, quantiles, distincts`.

    Numbers are read as doubles; NaN counts as null. All columns share one scan and one shuffle of sketches, built
    before the shuffle. A period without values keeps its counts, with null extremes and sums and empty sketches.
    Null periods and null groups are periods and groups of their own. Names of `by` may be any but the result's own.
    """
    clash = set(by) & set(sketch_schema(df, ()).names)
    if clash:
        raise ValueError(f"group columns clash with the columns of the sketches: {sorted(clash)}")
    number = {c: F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    measures = []
    for i, c in enumerate(columns):
        x = number[c]
        measures += [
            F.struct(
                F.lit(c).alias("column"),
                F.count("*").alias("rows"),
                F.count_if(x.isNull()).alias("nulls"),
                F.count_if(x == 0).alias("zeros"),
                F.min(x).alias("low"),
                F.max(x).alias("high"),
                F.sum(x).alias("total"),
                F.sum(x * x).alias("squares"),
                F.kll_sketch_agg_double(x, F.lit(size)).alias("quantiles"),
                # -0.0 and 0.0 are one value; a sketch hashes text
                F.hll_sketch_agg((x + F.lit(0.0)).cast("string"), F.lit(bits)).alias("distincts"),
            ).alias(f"_{i}")
        ]
    keys = [period.alias("period"), *[quoted(b) for b in by]]
    wide = df.groupBy(*keys).agg(*measures)
    long = wide.select("period", *[quoted(b) for b in by], F.explode(F.array(*[f"_{i}" for i in range(len(columns))])).alias("_s"))
    return long.select("period", *[quoted(b) for b in by], "_s.*")


def sketch_schema(df: DataFrame, by: Sequence[str], period: T.DataType | None = None) -> T.StructType:
    """Columns of the sketch table for groups of `df`."""
    counts = [T.StructField(n, T.LongType(), False) for n in ("rows", "nulls", "zeros")]
    doubles = [T.StructField(n, T.DoubleType()) for n in ("low", "high", "total", "squares")]
    sketches = [T.StructField(n, T.BinaryType()) for n in ("quantiles", "distincts")]
    keys = [T.StructField("period", period or T.StringType()), *[df.schema[b] for b in by], T.StructField("column", T.StringType(), False)]
    return T.StructType([*keys, *counts, *doubles, *sketches])


def add_periods(spark: SparkSession, path: str, df: DataFrame, period: Column, columns: Sequence[str], by: Sequence[str] = ()) -> int:
    """Sketch the periods of `df` that the table at `path` lacks and append them; the number of added rows.

    Stored periods are final: rows that come later for one of them are left out, its sketches are not written
    again. The table holds a few rows a period, so its periods meet the rows as a small side of a join.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    fresh = df.withColumn("_period", period)
    before = 0
    if stored:
        table = spark.read.parquet(path)
        before = table.count()
        known = table.select(F.col("period").alias("_known")).distinct()
        fresh = fresh.join(known, F.col("_period").eqNullSafe(F.col("_known")), "left_anti")
    sketch_columns(fresh, F.col("_period"), columns, by).write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - before


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of all periods of a group and column as one row; `by` may name groups or a coarser period."""
    return sketches.groupBy(*[quoted(b) for b in by], "column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.sum("zeros").alias("zeros"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("total").alias("total"),
        F.sum("squares").alias("squares"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distincts").alias("distincts"),
    )


def sketch_profile(merged: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Profile of each merged row: exact counts, extremes, mean and deviation; approximate quantiles and distincts.

    A quantile is a value of the data. Without values every measure but the counts is null and `distinct` is 0.
    """
    values = F.col("rows") - F.col("nulls")
    mean = F.try_divide(F.col("total"), values.cast("double"))
    spread = F.greatest(F.col("squares") - F.col("total") * mean, F.lit(0.0)) / (values - 1)
    keys = [quoted(c) for c in merged.columns[: merged.columns.index("rows")]]
    asked = F.kll_sketch_get_quantile_double("quantiles", F.array(*[F.lit(float(r)) for r in ranks]))
    found = F.when(values > 0, asked)
    return merged.select(
        *keys,
        "rows",
        "nulls",
        percent(F.col("nulls"), F.col("rows")).alias("null_percent"),
        "zeros",
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        mean.alias("mean"),
        F.when(values > 1, F.sqrt(spread)).alias("std"),
        *[found[i].alias(f"q{round(r * 100):02d}") for i, r in enumerate(ranks)],
        F.hll_sketch_estimate("distincts").alias("distinct"),
    )


def sketched_quantiles(df: DataFrame, ranks: dict[str, Sequence[float]], size: int = KLL_SIZE) -> dict[str, tuple[float | None, ...]]:
    """Approximate quantiles of several columns from one scan; a column without values has null quantiles."""
    if not ranks:
        return {}
    asked = []
    for c, wanted in ranks.items():
        x = F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double"))
        points = F.array(*[F.lit(float(r)) for r in wanted])
        asked.append(F.when(F.count(x) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(x, F.lit(size)), points)))
    row = df.agg(*[a.alias(f"_{i}") for i, a in enumerate(asked)]).first()
    return {c: tuple(found) if found else (None,) * len(ranks[c]) for c, found in zip(ranks, row, strict=True)}


def rank_errors(df: DataFrame, profile: DataFrame, column: str, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Distance of each approximate quantile of `column` from its rank, as a share of the values: a check by one scan.

    A value that stands often covers all ranks of its copies; the distance is to the nearest of them.
    """
    answers = profile.filter(F.col("column") == column).first()
    x = F.nanvl(quoted(column).cast("double"), F.lit(None).cast("double"))
    sides = []
    for r in ranks:
        answer = F.lit(answers[f"q{round(r * 100):02d}"]).cast("double")
        n = F.count(x).cast("double")
        under, upto = F.try_divide(F.count_if(x < answer), n), F.try_divide(F.count_if(x <= answer), n)
        sides.append(
            F.struct(
                F.lit(float(r)).alias("rank"), answer.alias("value"),
                F.greatest(under - r, F.lit(r) - upto, F.lit(0.0)).alias("error"),
            )
        )
    return df.agg(F.array(*sides).alias("s")).select(F.lit(column).alias("column"), F.explode("s").alias("s")).select("column", "s.*")
