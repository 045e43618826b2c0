"""Whole-table health counts and duplicate handling, all on pre-aggregated groups."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.functions.columns import groupable, quoted

ROWS = "group_rows"
HOT_SHARE = 1 / 1024
MASK_BITS = 62


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def row_groups(df: DataFrame) -> DataFrame:
    """Distinct rows with their multiplicity; copies collapse before the shuffle."""
    df = groupable(df)
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count("*").alias(ROWS))


def _row_digest(df: DataFrame) -> list[Column]:
    """Two independent 64-bit hashes of a row; a NULL differs from any value and from a NULL next to it."""
    parts = []
    for f in df.schema:
        value = quoted(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = value + F.lit(0.0).cast(f.dataType)  # one zero
        parts += [value, value.isNull()]
    return [F.xxhash64(*parts).alias("_hash"), F.xxhash64(F.lit("second"), *parts[::-1]).alias("_hash2")]


def table_health(df: DataFrame) -> DataFrame:
    """One row: row and column counts, null cells, null cells per column, both duplicate counts.

    Everything the score, summary and report operators need comes from this single scan. Rows are
    told apart by 128 bits of hashes, so the shuffle holds two hashes and the null pattern of a row
    instead of its columns.
    """
    plain, n = groupable(df), F.col(ROWS)
    chunks = [df.columns[i : i + MASK_BITS] for i in range(0, len(df.columns), MASK_BITS)]
    masks = []
    for i, names in enumerate(chunks):
        mask = F.lit(0).cast("bigint")
        for bit, c in enumerate(names):
            mask = mask + F.when(quoted(c).isNull(), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint")
        masks.append(mask.alias(f"_nulls{i}"))
    hashed = plain.select(*_row_digest(plain), *masks)
    groups = hashed.groupBy(*hashed.columns).agg(F.count("*").alias(ROWS))
    nulls = []
    for i, names in enumerate(chunks):
        for bit, c in enumerate(names):
            null = F.shiftright(f"_nulls{i}", bit).bitwiseAND(F.lit(1)) == 1
            nulls.append(_total(F.when(null, n)).alias(null_name(c)))
    counted = groups.agg(
        _total(n).alias("rows"),
        _total(n - 1).alias("duplicate_extras"),
        _total(F.when(n > 1, n)).alias("duplicate_members"),
        *nulls,
    )
    null_cells = F.lit(0).cast("bigint")
    for c in df.columns:
        null_cells = null_cells + quoted(null_name(c))
    return counted.select(
        "rows",
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        null_cells.alias("null_cells"),
        "duplicate_extras",
        "duplicate_members",
        *[quoted(null_name(c)) for c in df.columns],
    )


def null_name(column: str) -> str:
    """Name of the per-column null count in `table_health`."""
    return f"nulls {column}"


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One row of each group of identical rows."""
    return df.dropDuplicates()


def duplicate_groups(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Groups of rows that share all columns (or the keys), with their number of members; NULLs match."""
    source = groupable(df)
    grouped = source.groupBy(*[quoted(c) for c in (keys or source.columns)])
    return grouped.agg(F.count("*").alias("members")).filter(F.col("members") > 1)


def mark_duplicates(df: DataFrame, keys: Sequence[str], flag: str = "is_duplicate") -> DataFrame:
    """Every row with a 0/1 flag for sharing its key with another row; NULL keys match each other.

    Keys above `HOT_SHARE` of the rows number at most 1/HOT_SHARE, so that list is broadcast and
    their rows never meet in one task. The rest joins on the key.
    """
    repeated = duplicate_groups(df, keys)
    rows = df.count()
    threshold = max(2, math.ceil(rows * HOT_SHARE))
    hot = F.broadcast(_key_side(repeated.filter(F.col("members") >= threshold), keys))
    cold = _key_side(repeated.filter(F.col("members") < threshold), keys).withColumn("_repeated", F.lit(True))
    on = _same_key(keys)
    hot_rows = df.join(hot, on, "left_semi").withColumn(flag, F.lit(1))
    rest = df.join(hot, on, "left_anti").join(cold, on, "left")
    marked = rest.select(
        *[quoted(c) for c in df.columns],
        F.when(F.col("_repeated"), F.lit(1)).otherwise(F.lit(0)).alias(flag),
    )
    return hot_rows.unionByName(marked)


def _key_side(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    return groups.select(*[quoted(k).alias(f"_key_{i}") for i, k in enumerate(keys)])


def _same_key(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & quoted(k).eqNullSafe(F.col(f"_key_{i}"))
    return condition


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per non-null key: the first under `order`, a list of `column` or `-column` (descending).

    NULLs sort last, and the columns not named break ties, so the choice does not depend on
    partitioning. The filter on the row number becomes a group limit inside each task before the
    shuffle, so a hot key arrives as one row per task.
    """
    named = [item.lstrip("-") for item in order]
    ranking = [
        quoted(name).desc_nulls_last() if item.startswith("-") else quoted(name).asc_nulls_last()
        for item, name in zip(order, named, strict=True)
    ]
    ranking += [quoted(c).asc_nulls_last() for c in df.columns if c != key and c not in named]
    position = F.row_number().over(Window.partitionBy(quoted(key)).orderBy(*ranking))
    present = df.filter(quoted(key).isNotNull())
    return present.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def key_audit(df: DataFrame, key: str) -> DataFrame:
    """Counts of a primary key before any repair: rows, NULL keys, distinct keys, rows in repeated keys.

    NULL keys count as one repeated group, as rows that cannot be told apart.
    """
    n = F.col("n")
    per_key = df.groupBy(quoted(key).alias("key")).agg(F.count("*").alias("n"))
    return per_key.agg(
        _total(n).alias("rows"),
        _total(F.when(F.col("key").isNull(), n)).alias("null_keys"),
        F.count("key").alias("distinct_keys"),
        _total(F.when(n > 1, n)).alias("duplicate_members"),
    )
