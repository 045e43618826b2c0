"""Table and column profiles: nulls, numbers, categories, null patterns, correlations, scores."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendframe import fixed_values as fixed
from mendframe.functions.buckets import quality_state
from mendframe.functions.columns import melt, numeric_columns, quoted, string_columns, value_rows
from mendframe.functions.numeric import percent
from mendframe.operators.duplicates import null_name, table_health
from mendframe.operators.quantiles import MAX_RANGE_ROWS, exact_quantiles, present
from mendframe.operators.sketches import sketched_quantiles
from mendframe.session import temporary

PAIRS_PER_SCAN = 300
MASK_BITS = 62


def basic_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, repeated copies beyond the first, and all rows that have a copy."""
    return table_health(df).select("rows", "columns", "duplicate_extras", "duplicate_members")


def null_profile(df: DataFrame) -> DataFrame:
    """Null count, null percentage and reliability of every column, from one scan."""
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count_if(quoted(c).isNull()).alias(null_name(c)) for c in df.columns]
    )
    long = melt(
        counts, [{"column": F.lit(c), "nulls": quoted(null_name(c))} for c in df.columns], keep=["rows"]
    )
    null_percent = percent(F.col("nulls"), F.col("rows"))
    return long.select(
        "column", "nulls", null_percent.alias("null_percent"), (100 - null_percent).alias("reliability")
    )


def nulls_ranked(df: DataFrame) -> DataFrame:
    return null_profile(df).orderBy(F.desc("nulls"), "column")


def critical_columns(df: DataFrame, above: float = fixed.CRITICAL_NULL_PERCENT) -> DataFrame:
    """Columns whose null percentage, rounded to two digits, is above the limit."""
    return null_profile(df).filter(F.bround("null_percent", 2) > above).select("column", "null_percent")


def numeric_statistics(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float]]:
    """Scalars of each numeric column from one scan; they become literals in the later scans."""
    values = df.select(*[present(quoted(c)).alias(c) for c in columns])
    measures = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "std_pop": F.stddev_pop,
        "min": F.min,
        "max": F.max,
        "zeros": lambda c: F.count_if(c == 0),
        "negatives": lambda c: F.count_if(c < 0),
    }
    row = values.agg(
        *[measure(quoted(c)).alias(f"{name} {c}") for c in columns for name, measure in measures.items()]
    ).first()
    return {c: {name: row[f"{name} {c}"] for name in measures} for c in columns}


def outlier_fences(
    df: DataFrame,
    columns: Sequence[str],
    factor: float = fixed.IQR_FACTOR,
    max_rows: int = MAX_RANGE_ROWS,
) -> dict[str, tuple[float, float]]:
    """Lower and upper fence per column from exact quartiles; columns without values are left out."""
    quartiles = exact_quantiles(df, {c: (0.25, 0.75) for c in columns}, max_rows=max_rows)
    return {
        c: (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        for c, (q1, q3) in quartiles.items()
        if q1 is not None
    }


def beyond_fences(c: Column, fences: tuple[float, float]) -> Column:
    return (c < F.lit(fences[0])) | (c > F.lit(fences[1]))


def numeric_profile(
    df: DataFrame, columns: Sequence[str] | None = None, max_rows: int = MAX_RANGE_ROWS, approximate: bool = False
) -> DataFrame:
    """Distribution, zeros, negatives, outliers and reliability of every numeric column with values.

    The numeric columns are stored once for the scans of moments and exact quartiles; outliers beyond
    the resulting fences are counted from the input. Only scalars per column pass through the driver.
    NaN counts as NULL. With `approximate` the quartiles come from one scan of mergeable sketches:
    values of the data within the sketch's rank error, and fences and outliers that follow from them.
    """
    columns = list(columns if columns is not None else numeric_columns(df))
    if not columns:
        return df.sparkSession.createDataFrame([], NUMERIC_PROFILE_SCHEMA)
    with temporary(df.select(*[quoted(c) for c in columns]), "numbers") as numbers:
        statistics = numeric_statistics(numbers, columns)
        columns = [c for c in columns if statistics[c]["count"]]
        wanted = {c: (0.25, 0.5, 0.75) for c in columns}
        if approximate:
            quartiles = sketched_quantiles(numbers, wanted)
        else:
            quartiles = exact_quantiles(numbers, wanted, {c: statistics[c]["count"] for c in columns}, max_rows=max_rows)
    if not columns:
        return df.sparkSession.createDataFrame([], NUMERIC_PROFILE_SCHEMA)
    fences = {
        c: (q1 - fixed.IQR_FACTOR * (q3 - q1), q3 + fixed.IQR_FACTOR * (q3 - q1))
        for c, (q1, _, q3) in quartiles.items()
    }
    outliers = df.agg(
        *[F.count_if(beyond_fences(present(quoted(c)), fences[c])).alias(c) for c in columns]
    )
    records = []
    for c in columns:
        s, (q1, median, q3) = statistics[c], quartiles[c]
        n, zeros, negatives = (F.lit(s[k]).cast("bigint") for k in ("count", "zeros", "negatives"))
        record = {"column": F.lit(c), "count": n}
        for name, value in {
            "mean": s["mean"], "median": median, "std": s["std"], "min": s["min"], "max": s["max"],
            "q25": q1, "q75": q3,
        }.items():
            record[name] = F.lit(value).cast("double")
        record["zeros"], record["zeros_percent"] = zeros, percent(zeros, n)
        record["negatives"], record["negatives_percent"] = negatives, percent(negatives, n)
        record["outliers"], record["outliers_percent"] = quoted(c), percent(quoted(c), n)
        record["reliability"] = 100 - percent(zeros + negatives + quoted(c), n)
        records.append(record)
    return melt(outliers, records)


NUMERIC_PROFILE_SCHEMA = (
    "column string, count bigint, mean double, median double, std double, min double, max double, "
    "q25 double, q75 double, zeros bigint, zeros_percent double, negatives bigint, "
    "negatives_percent double, outliers bigint, outliers_percent double, reliability double"
)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count of each (column, value) pair of the string columns, NULL values included."""
    columns = list(columns if columns is not None else string_columns(df))
    return value_rows(df, columns, "string").groupBy("column", "value").agg(F.count("*").alias("n"))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """The k most frequent non-null values per column; ties go to the smaller value.

    The rank filter runs as a group limit inside each task before the ranking shuffle.
    """
    return _ranked(value_counts(df, columns), k)


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    """NULLs are ranked last and dropped after, so that the counts below stay shared with other uses."""
    value = F.col("value")
    order = Window.partitionBy("column").orderBy(value.isNull(), F.desc("n"), value)
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.filter(value.isNotNull()).select("column", "rank", "value", "n")


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """Cardinality, dominant value, diversity, top values and reliability of every string column."""
    n, value = F.col("n"), F.col("value")
    counts = value_counts(df, columns)
    totals = (
        counts.groupBy("column")
        .agg(
            F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0)).alias("count"),
            F.count("value").alias("distinct_values"),
            F.sum(n).alias("rows"),
        )
        .filter(F.col("count") > 0)
    )
    tops = (
        _ranked(counts, k)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("top"))
    )
    share = percent(F.col("top_count"), F.col("count"))
    return (
        totals.join(tops, "column")
        .select("*", F.col("top")[0]["value"].alias("top_value"), F.col("top")[0]["n"].alias("top_count"))
        .select(
            "column",
            "count",
            "distinct_values",
            "top_value",
            "top_count",
            share.alias("top_percent"),
            (100 - share).alias("diversity"),
            F.array_join(
                F.transform("top", lambda t: F.concat(t["value"], F.lit("="), t["n"].cast("string"))), "|"
            ).alias("top_values"),
            percent(F.col("count"), F.col("rows")).alias("reliability"),
        )
    )


def null_patterns(df: DataFrame) -> DataFrame:
    """Rows per combination of null columns: one 0/1 digit per column, and the count.

    The combination travels as bit masks, so the partial aggregation leaves a handful of groups.
    """
    chunks = [df.columns[i : i + MASK_BITS] for i in range(0, len(df.columns), MASK_BITS)]
    masks = []
    for i, chunk in enumerate(chunks):
        mask = F.lit(0).cast("bigint")
        for bit, c in enumerate(chunk):
            mask = mask + F.when(quoted(c).isNull(), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint")
        masks.append(mask.alias(f"mask{i}"))
    grouped = df.groupBy(*masks).agg(F.count("*").alias("rows"))
    digits = [
        F.when(F.col(f"mask{i}").bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0, F.lit("1")).otherwise(F.lit("0"))
        for i, chunk in enumerate(chunks)
        for bit, _ in enumerate(chunk)
    ]
    return grouped.select(F.concat(*digits).alias("pattern"), "rows")


def _pair_counts(df: DataFrame) -> DataFrame:
    """For each column pair: rows, nulls of each, rows with both null; computed on the few patterns."""
    patterns = null_patterns(df)
    digit = {c: F.substring("pattern", i + 1, 1) == "1" for i, c in enumerate(df.columns)}
    pairs = list(combinations(df.columns, 2))
    frames = []
    for start in range(0, len(pairs), PAIRS_PER_SCAN):
        part = pairs[start : start + PAIRS_PER_SCAN]
        singles = list(dict.fromkeys(c for pair in part for c in pair))
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        sums = patterns.agg(
            total(F.col("rows")).alias("rows"),
            *[total(F.when(digit[c], F.col("rows"))).alias(null_name(c)) for c in singles],
            *[
                total(F.when(digit[a] & digit[b], F.col("rows"))).alias(f"both {i}")
                for i, (a, b) in enumerate(part)
            ],
        )
        frames.append(
            melt(
                sums,
                [
                    {
                        "column_a": F.lit(a),
                        "column_b": F.lit(b),
                        "nulls_a": quoted(null_name(a)),
                        "nulls_b": quoted(null_name(b)),
                        "both_null": quoted(f"both {i}"),
                    }
                    for i, (a, b) in enumerate(part)
                ],
                keep=["rows"],
            )
        )
    return _stack(frames)


def null_pairs(df: DataFrame) -> DataFrame:
    """Column pairs that are null together in at least one row."""
    if len(df.columns) < 2:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, rows bigint, percent double")
    return (
        _pair_counts(df)
        .filter(F.col("both_null") > 0)
        .select(
            "column_a",
            "column_b",
            F.col("both_null").alias("both_null"),
            percent(F.col("both_null"), F.col("rows")).alias("percent"),
        )
    )


def missingness_correlation(df: DataFrame) -> DataFrame:
    """Correlation of the null indicators of each column pair; NULL where one never or always is null."""
    n, a, b, both = (F.col(c).cast("double") for c in ("rows", "nulls_a", "nulls_b", "both_null"))
    spread = F.sqrt(a * (n - a)) * F.sqrt(b * (n - b))
    return _pair_counts(df).select(
        "column_a", "column_b", F.try_divide(n * both - a * b, spread).alias("correlation")
    )


def pair_correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over the rows where both are present; NULL when either is constant there."""
    both_a, both_b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(both_a) * F.stddev_pop(both_b))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation of every pair of numeric columns, many pairs per scan."""
    columns = list(columns if columns is not None else numeric_columns(df))
    pairs = list(combinations(columns, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, correlation double")
    frames = []
    for start in range(0, len(pairs), PAIRS_PER_SCAN):
        part = pairs[start : start + PAIRS_PER_SCAN]
        row = df.agg(
            *[
                pair_correlation(quoted(a).cast("double"), quoted(b).cast("double")).alias(f"r{i}")
                for i, (a, b) in enumerate(part)
            ]
        )
        frames.append(
            melt(
                row,
                [
                    {"column_a": F.lit(a), "column_b": F.lit(b), "correlation": F.col(f"r{i}")}
                    for i, (a, b) in enumerate(part)
                ],
            )
        )
    return _stack(frames)


def high_correlations(
    df: DataFrame, columns: Sequence[str] | None = None, above: float = fixed.HIGH_CORRELATION
) -> DataFrame:
    return correlation_matrix(df, columns).filter(F.abs("correlation") > above)


def quality_score(df: DataFrame, duplicates: str = "members") -> DataFrame:
    """Completeness, consistency and the weighted score with its state.

    `duplicates` says which rows count against consistency: all `members` of duplicate groups, or
    only the `extras` beyond the first.
    """
    return score_from_health(table_health(df), duplicates)


def score_from_health(health: DataFrame, duplicates: str = "members") -> DataFrame:
    cells = F.col("rows") * F.col("columns")
    completeness = 100 - percent(F.col("null_cells"), cells)
    consistency = 100 - percent(F.col(f"duplicate_{duplicates}"), F.col("rows"))
    score = fixed.COMPLETENESS_WEIGHT * completeness + fixed.CONSISTENCY_WEIGHT * consistency
    return health.select(
        completeness.alias("completeness"),
        consistency.alias("consistency"),
        score.alias("score"),
        quality_state(score).alias("state"),
    )


def zeros_and_nulls(df: DataFrame) -> DataFrame:
    """Zeros and nulls of every column; text has no zeros."""
    numeric = set(numeric_columns(df))
    counts = df.agg(
        *[
            (F.count_if(quoted(c) == 0) if c in numeric else F.lit(0).cast("bigint")).alias(f"zeros {c}")
            for c in df.columns
        ],
        *[F.count_if(quoted(c).isNull()).alias(null_name(c)) for c in df.columns],
    )
    return melt(
        counts,
        [
            {"column": F.lit(c), "zeros": quoted(f"zeros {c}"), "nulls": quoted(null_name(c))}
            for c in df.columns
        ],
    )


def shape_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Population skewness and excess kurtosis; NULL for constant columns."""
    columns = list(columns if columns is not None else numeric_columns(df))
    row = df.agg(
        *[F.skewness(quoted(c)).alias(f"skewness {c}") for c in columns],
        *[F.kurtosis(quoted(c)).alias(f"kurtosis {c}") for c in columns],
    )
    without_nan = lambda c: F.when(~F.isnan(c), c)
    return melt(
        row,
        [
            {
                "column": F.lit(c),
                "skewness": without_nan(quoted(f"skewness {c}")),
                "kurtosis": without_nan(quoted(f"kurtosis {c}")),
            }
            for c in columns
        ],
    )


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked
