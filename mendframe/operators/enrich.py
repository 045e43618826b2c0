"""Lookup enrichment, group statistics and class summaries.

No broadcast hints: lookups are joined on equality and the size statistics of Catalyst and AQE
decide. Fact tables are aggregated per group before they meet a dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendframe import fixed_values as fixed
from mendframe.functions import numeric
from mendframe.functions.buckets import prestige_label, prestige_score
from mendframe.functions.columns import quoted
from mendframe.functions.hashing import hash_normal
from mendframe.functions.text import code_prefix, lookup_key, title


def neighbourhood_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.NEIGHBOURHOODS, "name string, stratum int, base_count bigint, base_value bigint")


def district_lookup(spark: SparkSession) -> DataFrame:
    """Tier 2 with its factors applied to the base count and value."""
    rows = spark.createDataFrame(
        fixed.DISTRICTS, "code string, name string, stratum int, count_factor double, value_factor double"
    )
    return rows.select(
        "code",
        "stratum",
        numeric.truncated(fixed.DISTRICT_BASE_COUNT * F.col("count_factor")).alias("base_count"),
        numeric.truncated(fixed.DISTRICT_BASE_VALUE * F.col("value_factor")).alias("base_value"),
    )


def static_neighbourhoods(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fixed.STATIC_NEIGHBOURHOODS,
        "name string, lat double, lon double, stratum int, average_value bigint, row_count bigint, zone string",
    )


def lookup_two_tier(
    df: DataFrame,
    name: str,
    code: str,
    tier1: DataFrame,
    tier2: DataFrame,
    defaults: dict[str, object],
    code_length: int = 2,
) -> DataFrame:
    """Attributes by trimmed upper-case name, else by code prefix, else defaults; `tier` tells which.

    `tier1` is unique by `name`, `tier2` by `code`. The tier that matched wins as a whole, even if
    some of its attributes are NULL. Each attribute of `defaults` exists in both tiers.
    """
    attributes = list(defaults)
    first = tier1.select(
        quoted("name").alias("_name"), *[quoted(a).alias(f"_1{a}") for a in attributes], F.lit(True).alias("_hit1")
    )
    second = tier2.select(
        quoted("code").alias("_code"), *[quoted(a).alias(f"_2{a}") for a in attributes], F.lit(True).alias("_hit2")
    )
    joined = df.join(first, lookup_key(quoted(name)) == F.col("_name"), "left").join(
        second, code_prefix(quoted(code), code_length) == F.col("_code"), "left"
    )

    def pick(from1, from2, otherwise):
        return F.when(F.col("_hit1"), from1).when(F.col("_hit2"), from2).otherwise(otherwise)

    return joined.select(
        *[quoted(c) for c in df.columns],
        *[pick(F.col(f"_1{a}"), F.col(f"_2{a}"), F.lit(defaults[a])).alias(a) for a in attributes],
        pick(F.lit(1), F.lit(2), F.lit(0)).alias("tier"),
    )


def scale_by_area(df: DataFrame, area: str, default_area: float = fixed.DEFAULT_AREA) -> DataFrame:
    """Counts scaled by area with a floor, totals, averages, density per km2, class and score.

    Expects `stratum`, `base_count` and `base_value`, as `lookup_two_tier` adds them.
    """
    surface = F.coalesce(quoted(area).cast("double"), F.lit(default_area))
    scaled = numeric.truncated(F.col("base_count") * (surface / fixed.AREA_PER_BASE_COUNT))
    counted = df.withColumn("area", surface).withColumn(
        "row_count", F.greatest(F.lit(fixed.MIN_COUNT).cast("bigint"), scaled)
    )
    valued = counted.withColumn("total_value", F.col("row_count") * F.col("base_value"))
    return valued.select(
        "*",
        numeric.truncated(F.col("total_value") / F.col("row_count")).alias("average_value"),
        F.try_divide(F.col("row_count").cast("double"), F.col("area") / fixed.SQUARE_METRES_PER_KM2).alias("density"),
        prestige_label(F.col("stratum")).alias("prestige"),
        prestige_score(F.col("stratum")).alias("score"),
    )


def classify(df: DataFrame, stratum: str, value: str | None = None) -> DataFrame:
    """Prestige label and score, by stratum alone or by stratum and value."""
    v = quoted(value) if value else None
    return df.select(
        "*", prestige_label(quoted(stratum), v).alias("prestige"), prestige_score(quoted(stratum), v).alias("score")
    )


def group_totals(df: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """Rows with a key, summed value and value per counted row of each group."""
    count, total = F.count(quoted(key)), F.sum(quoted(value))
    return df.groupBy(quoted(group).alias("group")).agg(
        count.alias("row_count"),
        total.alias("total_value"),
        F.try_divide(total, count.cast("double")).alias("average_value"),
    )


def top_groups(df: DataFrame, group: str, key: str, value: str, n: int = 12) -> DataFrame:
    """The n groups with most rows; ties by name; with a display title."""
    return (
        group_totals(df, group, key, value)
        .orderBy(F.desc("row_count"), F.asc_nulls_last("group"))
        .limit(n)
        .withColumn("title", title(F.col("group")))
    )


def group_statistics(df: DataFrame, group: str, key: str, value: str, area: str, level: str) -> DataFrame:
    """Count, total and mean value, mean area and mean level per group, largest group first."""
    return (
        df.groupBy(quoted(group).alias("group"))
        .agg(
            F.count(quoted(key)).alias("row_count"),
            F.sum(quoted(value)).alias("total_value"),
            F.avg(quoted(value)).alias("mean_value"),
            F.avg(quoted(area)).alias("mean_area"),
            F.avg(quoted(level).cast("double")).alias("mean_level"),
        )
        .orderBy(F.desc("row_count"), F.asc_nulls_last("group"))
    )


def attach_group_totals(
    dimension: DataFrame, name: str, facts: DataFrame, group: str, key: str, value: str, area: str
) -> DataFrame:
    """Real per-group aggregates on a dimension, joined on the trimmed upper-case name.

    The facts shrink to one row per name before the join; dimension rows without facts keep NULLs.
    """
    totals = _totals_by_name(facts, group, key, value, area)
    return (
        dimension.withColumn("_name", lookup_key(quoted(name)))
        .join(totals, "_name", "left")
        .drop("_name")
    )


def unmatched_groups(
    dimension: DataFrame, name: str, facts: DataFrame, group: str, key: str, value: str, area: str
) -> DataFrame:
    """Fact groups whose name the dimension lacks."""
    totals = _totals_by_name(facts, group, key, value, area)
    names = dimension.select(lookup_key(quoted(name)).alias("_name")).distinct()
    return totals.join(names, "_name", "left_anti").withColumnRenamed("_name", "name")


def _totals_by_name(facts, group, key, value, area):
    return facts.groupBy(lookup_key(quoted(group)).alias("_name")).agg(
        F.count(quoted(key)).alias("fact_rows"),
        F.sum(quoted(value)).alias("fact_value"),
        F.avg(quoted(area)).alias("fact_mean_area"),
    )


def class_summary(df: DataFrame, label: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """Members and sums per class in the fixed class order; classes without members show zeros."""
    spark = df.sparkSession
    classes = spark.createDataFrame(
        [(i + 1, row[0]) for i, row in enumerate(fixed.PRESTIGE)], "position int, label string"
    )
    measured = df.groupBy(quoted(label).alias("label")).agg(
        F.count("*").alias("members"), *[F.sum(value).alias(name) for name, value in (sums or {}).items()]
    )
    return (
        classes.join(measured, "label", "left")
        .na.fill(0, subset=["members", *(sums or {})])
        .select("position", "label", "members", *(sums or {}))
        .orderBy("position")
    )


def global_totals(df: DataFrame, count: str, value: str, group: str) -> DataFrame:
    """Groups, total count, total value and value per counted row."""
    rows, total = F.sum(quoted(count)), F.sum(quoted(value))
    return df.agg(
        F.count_distinct(quoted(group)).alias("groups"),
        rows.alias("row_count"),
        total.alias("total_value"),
        F.try_divide(total, rows.cast("double")).alias("average_value"),
    )


def fact_totals(df: DataFrame, group: str, value: str, level: str) -> DataFrame:
    """Rows, distinct groups, mean value and mean level of a fact table.

    Groups are counted on pre-aggregated rows, so no per-row distinct state is shuffled.
    """
    per_group = df.groupBy(quoted(group).alias("group")).agg(
        F.count("*").alias("n"),
        F.sum(quoted(value)).alias("v"),
        F.count(quoted(value)).alias("vn"),
        F.sum(quoted(level).cast("double")).alias("l"),
        F.count(quoted(level)).alias("ln"),
    )
    return per_group.agg(
        F.sum("n").alias("rows"),
        F.count("group").alias("groups"),
        F.try_divide(F.sum("v"), F.sum("vn").cast("double")).alias("mean_value"),
        F.try_divide(F.sum("l"), F.sum("ln").cast("double")).alias("mean_level"),
    )


def with_total_value(df: DataFrame, average: str, count: str) -> DataFrame:
    return df.withColumn("total_value", quoted(average) * quoted(count))


def scaled_size(df: DataFrame, count: str, style: tuple[float, float] = fixed.MARKER_LARGE) -> DataFrame:
    """Marker size from the share of the largest count; the maximum is one scalar read first."""
    base, span = style
    largest = df.agg(F.max(quoted(count)).cast("double")).first()[0]
    size = F.lit(base) + F.try_divide(quoted(count).cast("double"), F.lit(largest)) * F.lit(span)
    return df.withColumn("size", size)


def heat_points(
    df: DataFrame,
    name: str,
    count: str,
    score: str,
    lat: str,
    lon: str,
    rows_per_point: int = fixed.HEAT_ROWS_PER_POINT,
    spread: float = fixed.HEAT_SPREAD,
    chunk: int = 4096,
) -> DataFrame:
    """One jittered point per `rows_per_point` counted rows of each group, weighted by its score.

    Points come in chunks that are spread over the tasks, so a huge group is no single task.
    """
    points = numeric.truncated(quoted(count) / rows_per_point)
    chunks = (
        df.select(
            quoted(name).alias("name"),
            quoted(lat).cast("double").alias("lat"),
            quoted(lon).cast("double").alias("lon"),
            (quoted(score) / fixed.HEAT_WEIGHT_DIVISOR).alias("weight"),
            points.alias("points"),
        )
        .filter(F.col("points") >= 1)
        .withColumn("first", F.explode(F.expr(f"sequence(0L, points - 1, {chunk}L)")))
        .repartition("name", "first")
    )
    numbered = chunks.withColumn(
        "point", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + (chunk - 1), F.col("points") - 1)))
    )
    seed = F.concat_ws("#", "name", F.col("point").cast("string"))
    return numbered.select(
        "name",
        "point",
        (F.col("lat") + hash_normal(seed, "lat", spread)).alias("lat"),
        (F.col("lon") + hash_normal(seed, "lon", spread)).alias("lon"),
        "weight",
    )


def jittered_centres(
    df: DataFrame, key: str, centre: tuple[float, float] = fixed.CENTRE, spread: float = fixed.CENTRE_SPREAD
) -> DataFrame:
    """A position around one centre for each row, derived from its key."""
    return df.select(
        "*",
        (F.lit(centre[0]) + hash_normal(quoted(key), "lat", spread)).alias("lat"),
        (F.lit(centre[1]) + hash_normal(quoted(key), "lon", spread)).alias("lon"),
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*[quoted(c).asc_nulls_last() for c in order]).limit(n)
