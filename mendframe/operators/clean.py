"""Cleaning operators and the counts that document them."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe import fixed_values as fixed
from mendframe.functions import numeric, text
from mendframe.functions.columns import melt, quoted
from mendframe.operators.duplicates import key_audit, table_health
from mendframe.roles import Roles

CAP_SAMPLE = 10_000


def project_renamed(df: DataFrame, names: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Select target columns; each target lists one or more candidate source names, first match wins."""
    chosen = []
    for target, candidates in names.items():
        candidates = [candidates] if isinstance(candidates, str) else list(candidates)
        source = next((c for c in candidates if c in df.columns), None)
        if source is None:
            raise ValueError(f"no source column for {target}: tried {', '.join(candidates)}")
        chosen.append(quoted(source).alias(target))
    return df.select(*chosen)


def any_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in at least one of the columns."""
    return df.na.drop(how="all", subset=list(columns))


def row_cap(df: DataFrame, n: int, key: str, then: Sequence[str] = ()) -> DataFrame:
    """The first n rows by a key of any type, ties by the further columns; NULLs last.

    A bounded sample of keys gives one that at least n rows do not exceed, which a count confirms, so
    that only somewhat more than n rows of all partitions together reach the final ordering.
    """
    order = [quoted(c).asc_nulls_last() for c in (key, *then)]
    keys = df.select(quoted(key).alias("key"))
    rows = df.count()
    share = min(1.0, CAP_SAMPLE / max(rows, 1))
    sample = [r["key"] for r in keys.sample(share, seed=42).where("key IS NOT NULL").orderBy("key").collect()]
    place = len(sample) * n / max(rows, 1)
    while 0 < n < rows and (place := place + 3 * math.sqrt(place + 1)) < len(sample):
        bound = F.lit(sample[int(place)])
        if keys.where(F.col("key") <= bound).count() >= n:
            df = df.filter(quoted(key) <= bound)
            break
    return df.orderBy(*order).limit(n)


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected column: expected and actual type, state, values present and those the expected type cannot hold."""
    actual = {f.name: f.dataType for f in df.schema}
    counts, records = [], []
    for i, f in enumerate(expected):
        if f.name not in actual:
            state, found, present_values, lost = fixed.SCHEMA_MISSING, F.lit(None).cast("string"), F.lit(0), F.lit(0)
        else:
            state = fixed.SCHEMA_OK if actual[f.name] == f.dataType else fixed.SCHEMA_WRONG_TYPE
            found = F.lit(actual[f.name].simpleString())
            value = quoted(f.name)
            counts += [
                F.count(value).alias(f"present{i}"),
                F.count_if(value.isNotNull() & value.try_cast(f.dataType).isNull()).alias(f"lost{i}"),
            ]
            present_values, lost = F.col(f"present{i}"), F.col(f"lost{i}")
        records.append(
            {
                "column": F.lit(f.name),
                "expected": F.lit(f.dataType.simpleString()),
                "actual": found,
                "state": F.lit(state),
                "present": present_values.cast("bigint"),
                "lost": lost.cast("bigint"),
            }
        )
    return melt(df.agg(F.count("*").alias("rows"), *counts), records)


def coerce_types(df: DataFrame, texts: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """Text columns to string (NULL stays NULL); number columns to double, unreadable values to NULL."""
    types = {f.name: f.dataType for f in df.schema}
    columns = []
    for c in df.columns:
        value = quoted(c)
        if c in texts:
            value = value.cast("string").alias(c)
        elif c in numbers:
            value = text.parse_number(value) if isinstance(types[c], T.StringType) else value.cast("double")
            value = value.alias(c)
        columns.append(value)
    return df.select(*columns)


def type_changes(before: DataFrame, texts: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """Type of each column before and after `coerce_types`, values present before and after, from one scan."""
    after = coerce_types(before, texts, numbers)
    old = {f.name: f.dataType.simpleString() for f in before.schema}
    coerced = coerce_types(before.select("*", *[quoted(c).alias(f"before {c}") for c in before.columns]), texts, numbers)
    counts = coerced.agg(*[F.count(quoted(name)).alias(name) for c in before.columns for name in (c, f"before {c}")])
    records = [
        {
            "column": F.lit(f.name),
            "before": F.lit(old[f.name]),
            "after": F.lit(f.dataType.simpleString()),
            "present_before": quoted(f"before {f.name}"),
            "present_after": quoted(f.name),
        }
        for f in after.schema
    ]
    return melt(counts, records)


def drop_non_positive(df: DataFrame, column: str) -> DataFrame:
    """Remove rows whose value is zero or less; NULL is kept."""
    return df.filter(~F.coalesce(quoted(column) <= 0, F.lit(False)))


def repair_numbers(df: DataFrame, roles: Roles) -> DataFrame:
    """Drop non-positive measures, NULL scores out of range and negative sizes; zeros stay."""
    if roles.positive in df.columns:
        df = drop_non_positive(df, roles.positive)
    repaired = {
        roles.bounded: lambda c: numeric.null_outside(c, *roles.bounds),
        roles.non_negative: numeric.null_negative,
    }
    return df.select(*[repaired[c](quoted(c)).alias(c) if c in repaired else quoted(c) for c in df.columns])


def number_rule_counts(df: DataFrame, roles: Roles) -> DataFrame:
    """How many rows each numeric rule touches, in rule order (one scan)."""
    positive, bounded, size = (quoted(c) for c in (roles.positive, roles.bounded, roles.non_negative))
    kept = ~F.coalesce(positive <= 0, F.lit(False))
    low, high = roles.bounds
    counts = df.agg(
        F.count_if(positive <= 0).alias("dropped"),
        F.count_if(kept & ((bounded < low) | (bounded > high))).alias("outside"),
        F.count_if(kept & (size < 0)).alias("negative"),
        F.count_if(kept & (size == 0)).alias("zero"),
    )
    return melt(
        counts,
        [
            {"rule": F.lit("positive"), "column": F.lit(roles.positive), "rows": F.col("dropped")},
            {"rule": F.lit("in_range"), "column": F.lit(roles.bounded), "rows": F.col("outside")},
            {"rule": F.lit("non_negative"), "column": F.lit(roles.non_negative), "rows": F.col("negative")},
            {"rule": F.lit("zero_marked"), "column": F.lit(roles.non_negative), "rows": F.col("zero")},
        ],
    )


def standardize_categories(
    df: DataFrame, texts: Sequence[str], folded: Sequence[str], blank_as_null: bool = False
) -> DataFrame:
    """Trim all text columns and lower-case the folded ones; a blank stays a category unless asked."""
    columns = []
    for c in df.columns:
        value = quoted(c)
        if c in texts:
            value = text.folded(value) if c in folded else text.strip(value)
            if blank_as_null:
                value = F.when(value != "", value)
            value = value.alias(c)
        columns.append(value)
    return df.select(*columns)


def category_changes(df: DataFrame, texts: Sequence[str], folded: Sequence[str]) -> DataFrame:
    """Distinct non-null values of each text column before and after standardisation.

    Raw values are counted per column first, so each distinct value is folded once.
    """
    raw = (
        melt(df, [{"column": F.lit(c), "value": quoted(c).cast("string")} for c in texts])
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    after = F.when(F.col("column").isin(list(folded)), text.folded(F.col("value"))).otherwise(
        text.strip(F.col("value"))
    )
    by_result = raw.groupBy("column", after.alias("after")).agg(F.count("*").alias("raw_values"))
    return by_result.groupBy("column").agg(
        F.sum("raw_values").alias("distinct_before"), F.count("*").alias("distinct_after")
    )


def add_derived(df: DataFrame, roles: Roles) -> DataFrame:
    """Indicator, guarded ratio and zeroed imputation flags."""
    added = []
    if roles.indicator_source in df.columns:
        source = quoted(roles.indicator_source).cast("string")
        added.append(source.eqNullSafe(F.lit(roles.indicator_value)).cast("int").alias(roles.indicator))
    if roles.positive in df.columns and roles.non_negative in df.columns:
        ratio = numeric.ratio_or_null(quoted(roles.positive), quoted(roles.non_negative))
        added.append(ratio.alias(roles.ratio))
    added += [F.lit(0).alias(flag) for flag in roles.flags]
    return df.select("*", *added)


def cleaning_summary(initial: DataFrame, final: DataFrame) -> DataFrame:
    """Initial, final and removed rows, retention, columns, nulls and duplicates left."""
    before = initial.agg(F.count("*").alias("initial_rows"))
    after = table_health(final).select("rows", "columns", "null_cells", "duplicate_extras")
    # one row each: stacked and folded into one
    stacked = before.unionByName(after, allowMissingColumns=True)
    joined = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return joined.select(
        "initial_rows",
        F.col("rows").alias("final_rows"),
        (F.col("initial_rows") - F.col("rows")).alias("removed_rows"),
        numeric.percent(F.col("rows"), F.col("initial_rows")).alias("retention_percent"),
        F.col("columns").alias("final_columns"),
        F.col("null_cells").alias("final_nulls"),
        F.col("duplicate_extras").alias("final_duplicates"),
    )


def key_repair_summary(df: DataFrame, key: str) -> DataFrame:
    """Key audit with the state: repeated keys were repaired or there were none."""
    if key not in df.columns:
        return df.sparkSession.createDataFrame(
            [(None, None, None, None, fixed.KEY_NOT_FOUND)],
            "rows bigint, null_keys bigint, distinct_keys bigint, duplicate_members bigint, state string",
        )
    state = F.when(F.col("duplicate_members") == 0, fixed.KEY_OK).otherwise(fixed.KEY_FIXED)
    return key_audit(df, key).withColumn("state", state)
