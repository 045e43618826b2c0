"""The full cleaning chain and its audit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.functions.columns import melt, quoted
from mendframe.operators import clean
from mendframe.operators.duplicates import ROWS, _total, keep_first, row_groups
from mendframe.roles import PROPERTY_ROLES, PROPERTY_SCHEMA, Roles
from mendframe.session import materialized


@dataclass(frozen=True)
class Cleaned:
    """Lazy results of the chain: the cleaned rows, the audit metrics and the schema states."""

    data: DataFrame
    audit: DataFrame
    schema: DataFrame


def clean_table(df: DataFrame, roles: Roles = PROPERTY_ROLES, blank_as_null: bool = False) -> DataFrame:
    """Type, deduplicate, repair the key, repair numbers, standardise categories, derive features.

    Exact copies share their key, and `keep_first` keeps one row per key under a total order, so the
    copies go in the same single shuffle: a separate distinct would move the whole table once more
    and change nothing. Deduplication precedes case folding. Without a key column the copies are
    dropped by a distinct.
    """
    typed = clean.coerce_types(df, roles.texts, roles.numbers)
    if roles.key in df.columns:
        unique = keep_first(typed, roles.key, [o for o in roles.order if o.lstrip("-") in df.columns])
    else:
        unique = typed.dropDuplicates()
    return finish(unique, roles, blank_as_null)


def finish(unique: DataFrame, roles: Roles, blank_as_null: bool = False) -> DataFrame:
    """The row-wise steps after deduplication."""
    repaired = clean.repair_numbers(unique, roles)
    texts = [c for c in roles.texts if c in unique.columns]
    standard = clean.standardize_categories(repaired, texts, roles.folded_texts, blank_as_null)
    return clean.add_derived(standard, roles)


def cleaning_audit(df: DataFrame, roles: Roles = PROPERTY_ROLES) -> DataFrame:
    """Metrics of the duplicate and key steps in long form.

    Whole-row groups and then key groups: two aggregations give all counts of both steps.
    """
    typed = clean.coerce_types(df, roles.texts, roles.numbers)
    n = F.col(ROWS)
    per_key = (
        row_groups(typed)
        .groupBy(quoted(roles.key).alias("key"))
        .agg(F.sum(n).alias("raw_rows"), F.count("*").alias("rows"))
    )
    counts = per_key.agg(
        _total(F.col("raw_rows")).alias("rows_before"),
        _total(F.col("rows")).alias("rows_deduplicated"),
        _total(F.when(F.col("key").isNull(), F.col("rows"))).alias("null_keys"),
        F.count("key").alias("distinct_keys"),
        _total(F.when(F.col("rows") > 1, F.col("rows"))).alias("key_duplicate_members"),
    )
    metrics = {
        ("duplicates", "rows_before"): F.col("rows_before"),
        ("duplicates", "exact_duplicates"): F.col("rows_before") - F.col("rows_deduplicated"),
        ("duplicates", "rows_after"): F.col("rows_deduplicated"),
        ("key", "rows"): F.col("rows_deduplicated"),
        ("key", "null_keys"): F.col("null_keys"),
        ("key", "distinct_keys"): F.col("distinct_keys"),
        ("key", "duplicate_members"): F.col("key_duplicate_members"),
    }
    return melt(
        counts,
        [
            {"section": F.lit(section), "metric": F.lit(metric), "value": value.cast("double")}
            for (section, metric), value in metrics.items()
        ],
    )


def clean_with_audit(
    df: DataFrame, roles: Roles = PROPERTY_ROLES, expected: T.StructType = PROPERTY_SCHEMA
) -> Cleaned:
    """The chain with all its counts. The rows left after the key step are written once for them."""
    unique = materialized(keep_first(clean.coerce_types(df, roles.texts, roles.numbers), roles.key, roles.order))
    rules = clean.number_rule_counts(unique, roles).select(
        F.lit("numbers").alias("section"),
        F.concat_ws(" ", "column", "rule").alias("metric"),
        F.col("rows").cast("double").alias("value"),
    )
    changes = clean.category_changes(clean.repair_numbers(unique, roles), roles.texts, roles.folded_texts)
    categories = melt(
        changes,
        [
            {
                "section": F.lit("categories"),
                "metric": F.concat_ws(" ", "column", F.lit(name)),
                "value": F.col(name).cast("double"),
            }
            for name in ("distinct_before", "distinct_after")
        ],
    )
    data = finish(unique, roles)
    summary = clean.cleaning_summary(df, data)
    totals = melt(
        summary,
        [
            {"section": F.lit("summary"), "metric": F.lit(c), "value": quoted(c).cast("double")}
            for c in summary.columns
        ],
    )
    audit = cleaning_audit(df, roles).unionByName(rules).unionByName(categories).unionByName(totals)
    return Cleaned(data, audit, clean.schema_check(df, expected))
