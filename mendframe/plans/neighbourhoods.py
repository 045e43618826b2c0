"""Neighbourhood enrichment: features, two-tier lookup, scaled counts, class, real fact aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendframe import fixed_values as fixed
from mendframe.operators import enrich

DEFAULTS = {
    "stratum": fixed.DEFAULT_STRATUM,
    "base_count": fixed.DEFAULT_COUNT,
    "base_value": fixed.DEFAULT_VALUE,
}


def enrich_neighbourhoods(
    features: DataFrame,
    name: str = "nombre",
    code: str = "codigo",
    area: str = "st_area(shape)",
    tier1: DataFrame | None = None,
    tier2: DataFrame | None = None,
    code_length: int = 2,
) -> DataFrame:
    """Attributes, scaled counts, totals, density and class of each feature."""
    spark = features.sparkSession
    looked_up = enrich.lookup_two_tier(
        features,
        name,
        code,
        tier1 if tier1 is not None else enrich.neighbourhood_lookup(spark),
        tier2 if tier2 is not None else enrich.district_lookup(spark),
        DEFAULTS,
        code_length,
    )
    return enrich.scale_by_area(looked_up, area)


def enrich_with_facts(
    features: DataFrame, facts: DataFrame, name: str, group: str, key: str, value: str, area: str
) -> DataFrame:
    """Enriched features with the aggregates of their facts and the value per square metre."""
    attached = enrich.attach_group_totals(features, name, facts, group, key, value, area)
    return attached.withColumn(
        "value_per_m2", F.try_divide(F.col("average_value").cast("double"), F.col("fact_mean_area"))
    )
