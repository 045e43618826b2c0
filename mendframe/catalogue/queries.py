"""Every registered query: a function of (spark, folder of the tables) to a DataFrame.

Computed doubles are rounded where they are compared with another engine, as sums of doubles differ
in their last digits between engines.
"""

from __future__ import annotations

import functools
import itertools
import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.catalogue.tables import property_table, table
from mendframe import fixed_values as fixed
from mendframe.functions import buckets
from mendframe.functions.columns import quoted
from mendframe.functions.numeric import percent
from mendframe.functions.text import title
from mendframe.operators import boosting, clean, dependencies, duplicates, encoding, enrich, evaluate, geometry, health, intervals, missingness, models, profile, rules, sketches, splits
from mendframe.plans import cleaning, full_run, imputation, neighbourhoods
from mendframe.plans.profiling import profile_table
from mendframe.roles import PROPERTY_ROLES, PROPERTY_SCHEMA
from mendframe.session import materialized, shared_checkpoint_dir, spread
from mendframe.sources import readers, sample, writers
from mendframe.streaming import keyed, monitor

Query = Callable[[SparkSession, str], DataFrame]

ROLES = PROPERTY_ROLES
SMALL_MODELS = models.Settings(
    trees=8, forest_depth=5, rounds=4, boost_depth=3, boost_class_depth=3, parallelism=8
)
EVENT_FENCES = (-50.0, 200.0)
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """Doubles rounded to `digits`, or to the digits given for a column."""
    doubles = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.select(
        *[F.round(quoted(c), other.get(c, digits)).alias(c) if c in doubles else quoted(c) for c in df.columns]
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, which all executors share."""
    return f"{shared_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def typed_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.coerce_types(property_table(spark, sf_dir), ROLES.texts, ROLES.numbers)


def cleaned_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_table(property_table(spark, sf_dir), ROLES)


# --- profile ---------------------------------------------------------------------------------


@query
def profile_basic(spark, sf_dir):
    return profile.basic_profile(property_table(spark, sf_dir))


@query
def profile_nulls(spark, sf_dir):
    return rounded(profile.null_profile(property_table(spark, sf_dir)))


@query
def nulls_ranked(spark, sf_dir):
    return rounded(profile.nulls_ranked(property_table(spark, sf_dir)))


@query
def critical_columns(spark, sf_dir):
    return rounded(profile.critical_columns(property_table(spark, sf_dir), above=4.0))


@query
def profile_numeric(spark, sf_dir):
    return rounded(profile.numeric_profile(property_table(spark, sf_dir)))


@query
def profile_outliers(spark, sf_dir):
    measured = profile.numeric_profile(table(spark, sf_dir, "events"), ["value", "user_id"])
    return rounded(measured.select("column", "count", "q25", "q75", "outliers", "outliers_percent"))


@query
def profile_categorical(spark, sf_dir):
    return rounded(profile.categorical_profile(property_table(spark, sf_dir)))


@query
def top_values(spark, sf_dir):
    return profile.top_values(property_table(spark, sf_dir))


@query
def null_pairs(spark, sf_dir):
    return rounded(profile.null_pairs(property_table(spark, sf_dir)))


@query
def null_mask_patterns(spark, sf_dir):
    return profile.null_patterns(property_table(spark, sf_dir))


@query
def missing_corr(spark, sf_dir):
    return rounded(profile.missingness_correlation(property_table(spark, sf_dir)))


@query
def missing_mechanism(spark, sf_dir):
    """Whether values are missing completely at random: Little's statistic over the numbers of the properties."""
    numbers = ["avaluo_total", "area_construida", "puntaje"]
    test = missingness.missing_at_random(property_table(spark, sf_dir), numbers)
    return rounded(test.select("rows", "patterns", "statistic", "degrees", (F.col("p_value") < 0.05).cast("int").alias("rejected")), 4)


@query
def correlations(spark, sf_dir):
    return rounded(profile.correlation_matrix(property_table(spark, sf_dir)))


@query
def high_correlations(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("gross"),
    )
    return rounded(profile.high_correlations(lines))


@query
def quality_score(spark, sf_dir):
    return rounded(profile.quality_score(property_table(spark, sf_dir)))


@query
def zeros_nulls(spark, sf_dir):
    return profile.zeros_and_nulls(property_table(spark, sf_dir))


@query
def dup_groups(spark, sf_dir):
    return duplicates.duplicate_groups(property_table(spark, sf_dir))


@query
def dup_members(spark, sf_dir):
    marked = duplicates.mark_duplicates(property_table(spark, sf_dir), ["id_predio"])
    return marked.select("id_predio", "avaluo_total", "is_duplicate")


@query
def skew_kurtosis(spark, sf_dir):
    return rounded(profile.shape_statistics(property_table(spark, sf_dir)))


@query
def profile_report(spark, sf_dir):
    return profile_table(property_table(spark, sf_dir), "properties").report()


@query
def profile_metrics(spark, sf_dir):
    return rounded(profile_table(property_table(spark, sf_dir), "properties").metrics())


# --- cleaning --------------------------------------------------------------------------------


@query
def rename_project(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("nm_mtcla_prdio"),
        F.col("l_linenumber").alias("estrato_pre"),
        F.col("l_returnflag").alias("ds_barrio"),
        F.col("l_extendedprice").alias("ava_total_ava"),
        F.col("l_quantity").alias("area_con"),
        F.col("l_discount").alias("nm_ptje"),
        F.col("l_linestatus").alias("ds_tipo_constru"),
    )
    return readers.property_rows(raw)


@query
def any_not_null(spark, sf_dir):
    present = clean.any_present(property_table(spark, sf_dir), ["area_construida", "puntaje", "tipo_construccion"])
    return present.select("id_predio", "estrato", "avaluo_total", "area_construida")


@query
def row_cap(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return clean.row_cap(lines, 50_000, "l_orderkey", ["l_linenumber", "l_partkey", "l_extendedprice"])


@query
def first_rows(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand")
    return enrich.first_rows(parts, ["p_name", "p_partkey"], 20)


@query
def schema_check(spark, sf_dir):
    expected = T.StructType([*PROPERTY_SCHEMA.fields, T.StructField("zona", T.StringType())])
    return clean.schema_check(property_table(spark, sf_dir), expected)


@query
def coerce_types(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    written = (
        F.when(F.col("o_orderkey") % 17 == 0, F.lit("n/a"))
        .when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit(" \t"), key, F.lit(".50 ")))
        .when(F.col("o_orderkey") % 11 == 0, F.concat(key, F.lit("d")))
        .when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("-"), key, F.lit("e1")))
        .otherwise(key)
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", written.alias("measure"))
    return clean.coerce_types(orders, ["o_custkey"], ["measure"])


@query
def type_changes(spark, sf_dir):
    raw = property_table(spark, sf_dir)
    return clean.type_changes(raw, ROLES.texts, ROLES.numbers)


@query
def exact_dedup(spark, sf_dir):
    return duplicates.drop_exact_duplicates(property_table(spark, sf_dir))


@query
def pk_audit(spark, sf_dir):
    return clean.key_repair_summary(duplicates.drop_exact_duplicates(property_table(spark, sf_dir)), ROLES.key)


@query
def pk_keep_first(spark, sf_dir):
    return duplicates.keep_first(property_table(spark, sf_dir), ROLES.key, ROLES.order)


@query
def numeric_rules(spark, sf_dir):
    return clean.number_rule_counts(property_table(spark, sf_dir), ROLES)


@query
def found_dependencies(spark, sf_dir):
    """Which columns of a line determine which, and how many lines break the rule."""
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]
    found = dependencies.functional_dependencies(table(spark, sf_dir, "lineitem"), columns, tolerance=1.0)
    return rounded(found.withColumns({"determinant": F.array_join("determinant", ","), "holds": F.col("holds").cast("int")}))


@query
def null_out_of_range(spark, sf_dir):
    repaired = clean.repair_numbers(property_table(spark, sf_dir), ROLES)
    return repaired.select("id_predio", "avaluo_total", "area_construida", "puntaje")


@query
def standardize_categories(spark, sf_dir):
    standard = clean.standardize_categories(typed_properties(spark, sf_dir), ROLES.texts, ROLES.folded_texts)
    return standard.groupBy("estrato", "barrio_nombre", "tipo_construccion").agg(F.count("*").alias("n"))


@query
def category_changes(spark, sf_dir):
    return clean.category_changes(typed_properties(spark, sf_dir), ROLES.texts, ROLES.folded_texts)


@query
def derived_features(spark, sf_dir):
    derived = clean.add_derived(typed_properties(spark, sf_dir), ROLES)
    return derived.select("id_predio", "es_comercial", "avaluo_por_m2", *ROLES.flags)


@query
def cleaning_summary(spark, sf_dir):
    return rounded(
        clean.cleaning_summary(property_table(spark, sf_dir), cleaned_properties(spark, sf_dir))
    )


@query
def cleaning_audit(spark, sf_dir):
    return cleaning.cleaning_audit(property_table(spark, sf_dir), ROLES)


@query
def cleaning_report(spark, sf_dir):
    return rounded(cleaning.clean_with_audit(property_table(spark, sf_dir), ROLES).audit)


@query
def clean_chain(spark, sf_dir):
    return cleaned_properties(spark, sf_dir)


@query
def date_standardize(spark, sf_dir):
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 4
    written = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(kind == 2, F.date_format(day, "yyyyMMdd"))
        .otherwise(F.lit("unknown"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("written"))
    read = rules.standardize_dates(orders, "written", ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd"], "day")
    return read.select("o_orderkey", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query
def precision_align(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return rules.align_precision(parts, {"p_retailprice": 0})


@query
def rule_checks(spark, sf_dir):
    return rounded(
        rules.check_rules(
            property_table(spark, sf_dir),
            {
                "key present": rules.required("id_predio"),
                "size present": rules.required("area_construida"),
                "score in range": rules.in_range("puntaje", 0, 100),
                "value positive": F.col("avaluo_total") > 0,
            },
        )
    )


@query
def near_duplicates(spark, sf_dir):
    return rules.near_duplicate_groups(
        property_table(spark, sf_dir), ["barrio_nombre", "tipo_construccion"], ["id_predio", "avaluo_total"]
    )


# --- health ----------------------------------------------------------------------------------


@query
def exec_summary(spark, sf_dir):
    return rounded(health.executive_summary(cleaned_properties(spark, sf_dir)))


@query
def completeness_by_column(spark, sf_dir):
    return rounded(health.completeness_by_column(cleaned_properties(spark, sf_dir)))


def stored_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rows written once, for queries that scan them several times."""
    return materialized(cleaned_properties(spark, sf_dir), "cleaned")


def baseline_filled(cleaned: DataFrame) -> DataFrame:
    return models.group_mean_imputation(cleaned, "area_construida", "barrio_nombre", "area_construida_imputada")


@query
def stage_comparison(spark, sf_dir):
    cleaned = stored_properties(spark, sf_dir)
    return health.stage_comparison(
        {"original": property_table(spark, sf_dir), "cleaned": cleaned, "imputed": baseline_filled(cleaned)}
    )


@query
def outlier_change(spark, sf_dir):
    raw = property_table(spark, sf_dir)
    return health.outlier_change(raw, stored_properties(spark, sf_dir), ["avaluo_total", "area_construida", "puntaje"])


@query
def quality_history(spark, sf_dir):
    """Health of three stages written as the runs of a history, read back, each against the run before."""
    cleaned = stored_properties(spark, sf_dir)
    stages = {"1 original": property_table(spark, sf_dir), "2 cleaned": cleaned, "3 imputed": baseline_filled(cleaned)}
    folder = scratch(spark, "history")
    for run, df in stages.items():
        counts = health.table_health(df).select("rows", "null_cells", "duplicate_extras")
        writers.write_metrics(health.run_summary({run: counts}).drop("stage"), folder, run=run)
    return rounded(health.quality_trend(readers.read_metrics(spark, folder)))


@query
def imputation_counts(spark, sf_dir):
    return health.imputation_counts(baseline_filled(stored_properties(spark, sf_dir)))


@query
def dashboard_score(spark, sf_dir):
    return rounded(health.dashboard_score(property_table(spark, sf_dir)))


@query
def health_report(spark, sf_dir):
    return rounded(health.health_report(cleaned_properties(spark, sf_dir)))


@query
def null_matrix(spark, sf_dir):
    raw = property_table(spark, sf_dir)
    return health.null_matrix(raw, raw.columns)


@query
def group_quality_states(spark, sf_dir):
    complete = F.col("area_construida").isNotNull() & F.col("id_predio").isNotNull() & (F.col("avaluo_total") > 60_000)
    share = percent(F.count_if(complete), F.count("*"))
    groups = property_table(spark, sf_dir).groupBy("barrio_nombre", "estrato").agg(share.alias("share"))
    return rounded(
        groups.select(
            "barrio_nombre",
            "estrato",
            "share",
            buckets.quality_state(F.col("share") * 1.7).alias("state"),
            buckets.completeness_colour(F.col("share") * 2).alias("colour"),
        )
    )


@query
def run_summary(spark, sf_dir):
    raw, cleaned = property_table(spark, sf_dir), cleaned_properties(spark, sf_dir)
    return rounded(
        health.run_summary({"profile": profile.quality_score(raw), "cleaning": clean.cleaning_summary(raw, cleaned)})
    )


@query
def alerts(spark, sf_dir):
    raw, cleaned = property_table(spark, sf_dir), cleaned_properties(spark, sf_dir)
    score = profile.quality_score(raw).select(F.lit("score").alias("metric"), F.col("score").alias("value"))
    kept = clean.cleaning_summary(raw, cleaned).select(F.lit("retention_percent"), F.col("retention_percent"))
    fit = evaluate.regression_metrics(_priced_lines(spark, sf_dir), "actual", "predicted")
    return rounded(health.alerts(score.union(kept).union(fit.select(F.lit("r2"), F.col("r2")))))


@query
def quality_trend(spark, sf_dir):
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run"), F.col("event_type").alias("metric"))
        .agg(F.round(F.avg("value"), 6).alias("value"))
    )
    return rounded(health.quality_trend(daily))


def daily_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored sketches of a value and a key per day and kind of event, written in two runs that overlap."""
    events = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 23 != 0, F.col("value")))
    path = scratch(spark, "sketches")
    day, columns = F.date_format("ts", "yyyy-MM-dd"), ["value", "user_id"]
    sketches.add_periods(spark, path, events.filter(F.dayofmonth("ts") <= 15), day, columns, ["event_type"])
    sketches.add_periods(spark, path, events, day, columns, ["event_type"])
    return spark.read.parquet(path)


@query
def sketched_months(spark, sf_dir):
    """Months by merging the stored days; `sketched` is the number of values that the quantile sketch holds."""
    months = daily_sketches(spark, sf_dir).withColumn("month", F.substring("period", 1, 7))
    merged = sketches.merge_sketches(months, ["month", "event_type"])
    profiled = sketches.sketch_profile(merged).drop("q25", "q50", "q75", "distinct")
    held = merged.select("month", "event_type", "column", F.kll_sketch_get_n_double("quantiles").alias("sketched"))
    return rounded(profiled.join(held, ["month", "event_type", "column"]))


@query
def sketch_errors(spark, sf_dir):
    """Quantiles and distinct counts of all days merged: 1 where they lie within the bounds of the sketches."""
    profiled = materialized(sketches.sketch_profile(sketches.merge_sketches(daily_sketches(spark, sf_dir))), "sketched")
    events = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 23 != 0, F.col("value")))
    names = ["value", "user_id"]
    errors = functools.reduce(DataFrame.unionByName, [sketches.rank_errors(events, profiled, c) for c in names])
    exact = events.agg(*[F.count_distinct(c).alias(c) for c in names]).unpivot([], names, "column", "exact")
    off = F.abs(F.col("distinct") - F.col("exact")) / F.greatest(F.col("exact"), F.lit(1))
    counted = profiled.join(exact, "column").select("column", "exact", (off <= sketches.DISTINCT_ERROR).cast("int").alias("distinct_held"))
    return errors.join(counted, "column").select(
        "column", "rank", F.col("exact").alias("distinct_values"), "distinct_held",
        (F.col("error") <= sketches.RANK_ERROR).cast("int").alias("rank_held"),
    )


@query
def level_changes(spark, sf_dir):
    """Cumulative sums of the daily mean of each kind of event."""
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run"), F.col("event_type").alias("metric"))
        .agg(F.round(F.avg("value"), 6).alias("value"))
    )
    return rounded(health.level_changes(daily))


def priced_orders(spark, sf_dir):
    """Orders with out-of-fold prices; one order of 19 has no price."""
    price = F.when(F.col("o_orderkey") % 19 != 0, F.col("o_totalprice")).alias("price")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", price)
    return intervals.out_of_fold_means(orders, "o_orderkey", ["o_orderpriority", "o_orderstatus"], "price")


@query
def conformal_bins(spark, sf_dir):
    """Radii of 90 % intervals by bins of predictions, with their coverage of a fold that was kept out."""
    return rounded(intervals.conformal_bins(priced_orders(spark, sf_dir), "price", held=F.col("fold") == 0))


@query
def fill_intervals(spark, sf_dir):
    """Prices with their gaps filled and the interval of each fill."""
    orders = priced_orders(spark, sf_dir)
    bins = intervals.conformal_bins(orders, "price")
    return rounded(intervals.fill_with_intervals(orders, "price", bins).drop("fold", "o_orderpriority", "o_orderstatus"), 4)


@query
def four_part_score(spark, sf_dir):
    return rounded(
        rules.four_part_score(
            property_table(spark, sf_dir),
            consistent=F.col("avaluo_total") > 0,
            valid=F.col("puntaje").between(0, 100),
            formatted=F.col("barrio_nombre") == F.trim("barrio_nombre"),
        )
    )


# --- enrichment ------------------------------------------------------------------------------


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as neighbourhood features: padded mixed-case names, codes, areas with gaps."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(key % 2 == 0, F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" "))).otherwise(F.col("p_brand")).alias("nombre"),
        F.concat(F.col("p_type"), key.cast("string")).alias("codigo"),
        F.when(key % 10 != 0, F.col("p_retailprice") * 100).alias("st_area(shape)"),
    )


def part_lookups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Tier 1 for some of the brands, tier 2 for some of the types."""
    parts = table(spark, sf_dir, "part")
    number = F.substring_index("p_brand", "#", -1).cast("int")
    tier1 = (
        parts.select(F.upper("p_brand").alias("name"), number.alias("n"))
        .filter(F.col("n") <= 12)
        .distinct()
        .select(
            "name",
            (F.col("n") % 6 + 1).alias("stratum"),
            (300 + 100 * F.col("n")).cast("bigint").alias("base_count"),
            (F.col("n") * 30_000_000).cast("bigint").alias("base_value"),
        )
    )
    code = F.substring("p_type", 1, 2)
    tier2 = (
        parts.select(code.alias("code"), F.length("p_type").alias("n"))
        .filter(F.col("code").isin("EC", "PR", "LA"))
        .distinct()
        .select(
            "code",
            (F.col("n") - 3).alias("stratum"),
            F.lit(800).cast("bigint").alias("base_count"),
            (F.col("n") * 20_000_000).cast("bigint").alias("base_value"),
        )
    )
    return tier1, tier2


def enriched_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier1, tier2 = part_lookups(spark, sf_dir)
    return neighbourhoods.enrich_neighbourhoods(part_features(spark, sf_dir), tier1=tier1, tier2=tier2)


@query
def lookup_two_tier(spark, sf_dir):
    tier1, tier2 = part_lookups(spark, sf_dir)
    found = enrich.lookup_two_tier(
        part_features(spark, sf_dir), "nombre", "codigo", tier1, tier2, neighbourhoods.DEFAULTS
    )
    return found.select("id", "stratum", "base_count", "base_value", "tier")


@query
def shipped_lookup(spark, sf_dir):
    """The shipped lookup tables, met by names and district codes that the parts' keys point to."""
    names = [n for n, *_ in fixed.NEIGHBOURHOODS]
    names = F.array(*[F.lit(n) for n in [*names, "nowhere", "elsewhere", "far away"]])
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit(" "), F.lower(names[(F.col("p_partkey") % F.size(names)).cast("int")]), F.lit("  ")).alias("nombre"),
        F.lpad((F.col("p_partkey") % 20 + 1).cast("string"), 2, "0").alias("codigo"),
    )
    found = enrich.lookup_two_tier(
        parts, "nombre", "codigo", enrich.neighbourhood_lookup(spark), enrich.district_lookup(spark), neighbourhoods.DEFAULTS
    )
    static = enrich.static_neighbourhoods(spark).select(F.upper("name").alias("static_name"), "lat", "lon", "zone")
    placed = found.join(static, F.upper(F.trim("nombre")) == F.col("static_name"), "left")
    return placed.select("p_partkey", title(F.trim("nombre")).alias("shown"), "stratum", "base_count", "base_value", "tier", "lat", "lon", "zone")


@query
def near_spellings(spark, sf_dir):
    """Brands with one changed, lost or added character for some suppliers' parts: found by one edit."""
    brand, kind = F.col("p_brand"), F.col("p_partkey") % 6
    changed = (
        F.when(kind == 0, F.concat(F.substring(brand, 1, 3), F.lit("e"), F.expr("substring(p_brand, 5)")))
        .when(kind == 1, F.concat(brand, F.lit("x")))
        .when(kind == 2, F.expr("substring(p_brand, 2)"))
        .otherwise(brand)
    )
    parts = table(spark, sf_dir, "part").select(changed.alias("brand"), "p_type")
    return rules.near_spellings(parts, "brand", 1, ["p_type"])


@query
def critical_columns_default(spark, sf_dir):
    """Columns over the default share of nulls, where the buildings of every third part are unknown."""
    unknown = F.col("l_partkey") % 3 == 0
    lines = table(spark, sf_dir, "lineitem")
    return rounded(
        profile.critical_columns(
            lines.select("l_orderkey", F.when(~unknown, F.col("l_tax")).alias("l_tax"), F.when(F.col("l_partkey") % 7 > 0, F.col("l_discount")).alias("l_discount"))
        )
    )


@query
def neighbourhood_enrich(spark, sf_dir):
    return rounded(enriched_parts(spark, sf_dir).drop("codigo", "st_area(shape)"))


@query
def prestige_v1(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") % 7).alias("stratum"), ((F.col("p_partkey") % 100) * 4_000_000).alias("value")
    )
    return enrich.classify(parts, "stratum", "value")


@query
def prestige_v2(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 7).alias("stratum"))
    return enrich.classify(parts, "stratum")


@query
def top_groups(spark, sf_dir):
    top = enrich.top_groups(cleaned_properties(spark, sf_dir), "barrio_nombre", "id_predio", "avaluo_total")
    return rounded(top, total_value=2).drop("title")


@query
def group_totals(spark, sf_dir):
    return rounded(
        enrich.group_totals(property_table(spark, sf_dir), "barrio_nombre", "id_predio", "area_construida"),
        total_value=2,
    )


@query
def group_stats(spark, sf_dir):
    return rounded(
        enrich.group_statistics(
            property_table(spark, sf_dir), "barrio_nombre", "id_predio", "avaluo_total", "area_construida", "estrato"
        ),
        total_value=2,
    )


@query
def class_summary(spark, sf_dir):
    parts = enrich.classify(
        table(spark, sf_dir, "part").withColumn("stratum", F.col("p_size") % 4), "stratum"
    )
    return enrich.class_summary(
        parts, "prestige", {"size_total": F.col("p_size").cast("bigint"), "keys": F.col("p_partkey")}
    )


@query
def global_totals(spark, sf_dir):
    return rounded(enrich.global_totals(enriched_parts(spark, sf_dir), "row_count", "total_value", "nombre"))


@query
def fact_totals(spark, sf_dir):
    return rounded(enrich.fact_totals(property_table(spark, sf_dir), "barrio_nombre", "avaluo_total", "estrato"))


def brand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per brand: number, counted line items, mean price."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    per_part = lines.groupBy("l_partkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    return (
        per_part.join(parts, per_part.l_partkey == parts.p_partkey)
        .groupBy("p_brand")
        .agg(F.sum("n").alias("row_count"), F.sum("q").cast("bigint").alias("quantity"))
        .withColumn("number", F.substring_index("p_brand", "#", -1).cast("int"))
    )


@query
def scaled_size(spark, sf_dir):
    return rounded(enrich.scaled_size(brand_rows(spark, sf_dir).select("p_brand", "row_count"), "row_count"))


@query
def total_value(spark, sf_dir):
    return enrich.with_total_value(
        brand_rows(spark, sf_dir).select("p_brand", "quantity", "row_count"), "quantity", "row_count"
    )


@query
def heat_points(spark, sf_dir):
    groups = brand_rows(spark, sf_dir).select(
        "p_brand",
        "row_count",
        (F.lit(6.0) + F.col("number") / 100).alias("lat"),
        (F.lit(-75.0) - F.col("number") / 100).alias("lon"),
        buckets.prestige_score(F.col("number") % 6 + 1).alias("score"),
    )
    return rounded(enrich.heat_points(groups, "p_brand", "row_count", "score", "lat", "lon"))


@query
def jittered_centres(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey")
    return rounded(enrich.jittered_centres(parts, "p_partkey"))


def nation_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations, with padded lower-case names; every fourth is spelt in another way."""
    name = F.when(F.col("n_nationkey") % 4 == 3, F.concat(F.lit("x"), F.lower("n_name"))).otherwise(F.lower("n_name"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("  "), name, F.lit(" ")).alias("nombre"))


def nation_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the name of their nation."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = table(spark, sf_dir, "customer")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        "n_name", "c_custkey", "c_acctbal"
    )


@query
def group_attach(spark, sf_dir):
    attached = enrich.attach_group_totals(
        nation_dimension(spark, sf_dir), "nombre", nation_facts(spark, sf_dir), "n_name", "c_custkey", "c_acctbal", "c_acctbal"
    )
    return rounded(attached.drop("nombre"), fact_value=2)


@query
def unmatched_groups(spark, sf_dir):
    missing = enrich.unmatched_groups(
        nation_dimension(spark, sf_dir), "nombre", nation_facts(spark, sf_dir), "n_name", "c_custkey", "c_acctbal", "c_acctbal"
    )
    return rounded(missing, fact_value=2)


# --- splits, encoding, metrics, imputation -----------------------------------------------------


@query
def split_hash(spark, sf_dir):
    return splits.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query
def split_stratified(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return splits.stratified_split(parts, "p_partkey", "p_type")


@query
def fold_assign(spark, sf_dir):
    return splits.add_fold(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey")


@query
def median_fill_scale(spark, sf_dir):
    columns = ["avaluo_total", "area_construida", "puntaje"]
    return rounded(encoding.fill_and_scale(property_table(spark, sf_dir).select("id_predio", *columns), columns))


@query
def category_cap(spark, sf_dir):
    return encoding.category_cap(table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"])


@query
def class_weights(spark, sf_dir):
    return rounded(evaluate.class_weights(property_table(spark, sf_dir), "tipo_construccion"))


def _priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.col("l_extendedprice").alias("actual"),
        (F.lit(40_000.0) + F.col("l_quantity") * 500).alias("predicted"),
        F.when(F.col("l_quantity") > 25, "A").otherwise("N").alias("guess"),
    )


@query
def regression_metrics(spark, sf_dir):
    return rounded(evaluate.regression_metrics(_priced_lines(spark, sf_dir), "actual", "predicted", ["l_returnflag"]))


@query
def classification_metrics(spark, sf_dir):
    return rounded(evaluate.classification_metrics(_priced_lines(spark, sf_dir), "l_returnflag", "guess"))


@query
def confusion(spark, sf_dir):
    return evaluate.confusion_matrix(_priced_lines(spark, sf_dir), "l_returnflag", "guess")


def baseline_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 per fold of two predictors of the order price: mean by priority, and by status.

    The means of a fold come from the group sums of all folds less its own, so no row is read twice.
    """
    orders = splits.add_fold(table(spark, sf_dir, "orders"), "o_orderkey")
    frames = []
    for position, group in enumerate(["o_orderpriority", "o_orderstatus"]):
        y = F.col("o_totalprice")
        sums = orders.groupBy("fold", F.col(group).alias("g")).agg(
            F.sum(y).alias("s"), F.sum(y * y).alias("ss"), F.count("*").alias("n")
        )
        totals = sums.groupBy("g").agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
        mean = (F.col("all_s") - F.col("s")) / (F.col("all_n") - F.col("n"))
        scored = sums.join(totals, "g").withColumn("p", mean)
        squared = F.sum(F.col("ss") - 2 * F.col("p") * F.col("s") + F.col("n") * F.col("p") * F.col("p"))
        spread = F.sum("ss") - F.sum("s") * F.sum("s") / F.sum("n")
        frames.append(
            scored.groupBy("fold").agg((1 - squared / spread).alias("r2")).select(
                F.lit(position).alias("position"), F.lit(group).alias("candidate"), "fold", "r2"
            )
        )
    return frames[0].unionByName(frames[1])


@query
def cross_validation(spark, sf_dir):
    return rounded(
        evaluate.cross_validation_summary(baseline_fold_scores(spark, sf_dir), ["position", "candidate"], "r2")
    )


@query
def model_select(spark, sf_dir):
    scores = evaluate.cross_validation_summary(baseline_fold_scores(spark, sf_dir), ["position", "candidate"], "r2")
    return rounded(evaluate.select_best(scores))


@query
def baseline_impute(spark, sf_dir):
    filled = baseline_filled(stored_properties(spark, sf_dir))
    return rounded(filled.select("id_predio", "barrio_nombre", "area_construida", "area_construida_imputada"))


def _trained(spark: SparkSession, sf_dir: str, position: int):
    """The cleaned rows and an imputer of the whole sizes."""
    cleaned = stored_properties(spark, sf_dir)
    return cleaned, models.train(cleaned, ROLES.targets[position], ROLES.key, models.Settings())


def _whole(column: str):
    """Whether a filled value is one the column can hold."""
    rules = {
        "area_construida": lambda c: c >= 0,
        "puntaje": lambda c: c.between(0, 100),
        "tipo_construccion": lambda c: c.isin("r", "a", "n", ""),
    }
    return F.coalesce(rules[column](F.col(column)), F.lit(False))


def _held(filled: DataFrame, imputer: models.Imputer) -> DataFrame:
    """What SQL can check of a filled column: values kept, flags, no gap and no wrong value left, the best candidate chosen."""
    target = imputer.target
    score = "cv_accuracy" if target.kind == "category" else "cv_r2"
    scores = {m["candidate"]: m[score] for m in imputer.metrics}
    return filled.select(
        "id_predio",
        F.when(F.col(target.flag) == 0, F.col(target.column)).alias("kept"),
        target.flag,
        _whole(target.column).cast("int").alias("whole"),
        F.lit(int(scores[imputer.chosen] == max(scores.values()))).alias("best"),
    )


@query
def impute_numeric(spark, sf_dir):
    cleaned, imputer = _trained(spark, sf_dir, 0)
    return _held(imputer.impute(cleaned), imputer)


@query
def impute_bounded(spark, sf_dir):
    cleaned, imputer = _trained(spark, sf_dir, 1)
    folder = scratch(spark, "model")
    imputer.save(folder)
    loaded = models.Imputer.load(spark, folder)
    return _held(loaded.impute(cleaned), loaded)


@query
def impute_category(spark, sf_dir):
    cleaned, imputer = _trained(spark, sf_dir, 2)
    return _held(imputer.impute(cleaned), imputer)


@query
def impute_confidence(spark, sf_dir):
    cleaned, imputer = _trained(spark, sf_dir, 2)
    filled = imputer.impute(cleaned, provenance=True).filter("tipo_construccion_imputado = 1")
    return filled.groupBy(
        F.col("tipo_construccion_method").alias("method"),
        F.floor(F.col("tipo_construccion_confidence") * 10).alias("confidence_tenth"),
    ).agg(F.count("*").alias("n"))


@query
def boosted_classes(spark, sf_dir):
    """Held-out rows of the class column with what SQL can check of the boosted probabilities.

    `whole`: the probabilities are between 0 and 1, sum to 1, and the prediction has the largest;
    `falls`: the log loss fell in every round; `beats`: more held-out rows are right than
    there are rows of the commonest class (`commonest`).
    """
    target = ROLES.targets[2]
    known = stored_properties(spark, sf_dir).filter(quoted(target.column).isNotNull())
    rows = splits.stratified_split(known, ROLES.key, target.column)
    training, held = rows.filter("is_test = 0"), rows.filter("is_test = 1")
    encoder = encoding.fit_encoders(training, target.categories, target.numbers, 0)[None]
    labels = sorted(r[0] for r in training.select(target.column).distinct().collect())
    indexer = StringIndexerModel.from_labels(labels, target.column, "label", handleInvalid="error")
    booster = boosting.SoftmaxBoosting(
        len(labels), rounds=SMALL_MODELS.rounds, depth=SMALL_MODELS.boost_class_depth, step=0.3, track=True
    )
    model = Pipeline(stages=[indexer, *encoder.stages(), booster]).fit(encoder.mark_seen(training))
    falls = all(b < a for a, b in itertools.pairwise(booster.losses))
    p, chosen = F.col("p"), F.col("prediction").cast("int")
    scored = model.transform(encoder.mark_seen(held)).withColumn("p", vector_to_array("probability"))
    total = F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
    whole = (F.abs(total - 1) < 1e-9) & F.forall(p, lambda x: x.between(0, 1)) & (p[chosen] == F.array_max(p))
    by_class = materialized(
        scored.groupBy(target.column).agg(
            F.count("*").alias("n"), F.count_if(chosen == F.col("label")).alias("hits"), F.count_if(~whole).alias("broken")
        ),
        "boosted",
    )
    hits, commonest = by_class.agg(F.sum("hits"), F.max("n")).first()
    return by_class.select(
        F.col(target.column).alias("label"),
        "n",
        "broken",
        F.lit(commonest).alias("commonest"),
        F.lit(int(falls)).alias("falls"),
        F.lit(int((hits or 0) > (commonest or 0))).alias("beats"),
    )


def _chain_held(data: DataFrame) -> DataFrame:
    whole = F.lit(True)
    for t in ROLES.targets:
        whole = whole & _whole(t.column)
    return data.select(
        "id_predio",
        *[F.when(F.col(t.flag) == 0, F.col(t.column)).alias(f"kept_{t.column}") for t in ROLES.targets],
        *ROLES.flags,
        whole.cast("int").alias("whole"),
    )


@query
def impute_chain(spark, sf_dir):
    """The chain with the provenance of its fills, whose other columns stay as they are."""
    settings = models.Settings(**{**SMALL_MODELS.__dict__, "seed": 7})
    return _chain_held(imputation.train_and_impute(stored_properties(spark, sf_dir), ROLES, settings, provenance=True).data)


@query
def impute_contract(spark, sf_dir):
    """What any model must keep: present values, flags only on gaps, no gap left, bounds respected."""
    return _chain_held(imputation.train_and_impute(stored_properties(spark, sf_dir), ROLES, SMALL_MODELS).data)


@query
def four_stage_run(spark, sf_dir):
    return full_run.run_all(property_table(spark, sf_dir), ROLES, SMALL_MODELS).summary


# --- sources, sinks, streams -------------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    name, kind = F.col("c_name"), F.col("c_custkey") % 7
    note = (
        F.when(kind == 0, F.concat(F.lit("  padded "), name, F.lit("\t ")))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit(None))
        .when(kind == 3, F.concat(F.lit('say "'), name, F.lit('", twice, "x"')))
        .when(kind == 4, F.concat(F.lit("first line\nsecond "), name, F.lit("\r\n\nlast")))
        .when(kind == 5, F.concat(F.lit('back\\slash \\"'), name, F.lit("\\")))
        .otherwise(F.lit("# 'plain', text"))
    )
    noted = customers.withColumn("note", note)
    folder = scratch(spark, "csv")
    writers.write_csv(noted, folder)
    return readers.read_csv(spark, folder, noted.schema)


@query
def geojson_roundtrip(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    geometry = F.concat(
        F.lit('{"type":"Polygon","coordinates":[[['), F.col("p_partkey").cast("string"), F.lit(","),
        F.col("p_size").cast("string"), F.lit("],[0,0],[1,1]]]}"),
    )
    features = parts.select(
        F.col("p_name").alias("nombre"),
        F.col("p_partkey").cast("string").alias("codigo"),
        F.col("p_retailprice").alias("st_area(shape)"),
        geometry.alias("geometry"),
    )
    folder = scratch(spark, "geojson")
    writers.write_geojson_lines(features, folder)
    read = readers.read_geojson(spark, folder, line_delimited=True)
    return read.select("nombre", "codigo", F.col("`st_area(shape)`").alias("area"), *readers.first_vertex("geometry"))


def part_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as plots in rows of a hundred: a slanted outline of their size, every fifth size with a hole, some parts much larger."""
    wide = F.expr("p_size + 1 + if(p_partkey % 97 = 0, 300, 0)").cast("long")
    rows = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select(
        "p_partkey", "p_size", wide.alias("w"), F.expr("p_partkey % 100 * 20").alias("x"), F.expr("p_partkey div 100 * 20").alias("y")
    )
    outline = "format_string('[[%d,%d],[%d,%d],[%d,%d],[%d,%d]]', x, y, x + w, y, x + 2 * w, y + w, x, y + 2 * w)"
    hole = "if(p_size % 5 = 0, format_string(',[[%d,%d],[%d,%d],[%d,%d]]', x, y, x, y + w, x + w, y), '')"
    shape = F.expr(f"concat('{{\"type\":\"Polygon\",\"coordinates\":[', {outline}, {hole}, ']}}')")
    return rows.select("p_partkey", shape.alias("geometry"))


@query
def shape_measures(spark, sf_dir):
    """Area and centroid of the plots, from their GeoJSON."""
    shapes = part_shapes(spark, sf_dir).select("p_partkey", geometry.measures(geometry.polygons(F.col("geometry"))).alias("m"))
    return rounded(shapes.select("p_partkey", "m.area", F.col("m.x").alias("cx"), F.col("m.y").alias("cy")), 4)


@query
def located_customers(spark, sf_dir):
    """The plots that customers stand on: the one with the smallest key and how many there are; some have no place."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.expr("if(c_custkey % 50 = 0, null, c_custkey * 7919 % 2000 + 0.25D)").alias("x"),
        F.expr("c_custkey div 75 * 20 + c_custkey * 31 % 41 + 0.5D").alias("y"),
    )
    return geometry.attach_by_location(customers, part_shapes(spark, sf_dir), "x", "y", "p_partkey", "geometry", "p_partkey", "plots")


@query
def metrics_roundtrip(spark, sf_dir):
    folder = scratch(spark, "metrics")
    writers.write_metrics(rounded(health.health_report(property_table(spark, sf_dir))), folder, run="r1")
    return spark.read.schema("section string, column string, metric string, value double, run string").json(folder)


@query
def sample_generator(spark, sf_dir):
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    return sample.sample_properties(brands, "p_brand")


@query
def stream_quality(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    arriving = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    counted = monitor.windowed_health(arriving, "ts", "value", EVENT_FENCES, by=["event_type"])
    folder = scratch(spark, "stream")
    monitor.run_available(counted, f"{folder}/table", f"{folder}/checkpoint")
    latest = monitor.latest_windows(spark.read.parquet(f"{folder}/table"), by=["event_type"])
    start = F.to_utc_timestamp("window_start", F.current_timezone())
    return rounded(latest.withColumn("window_start", F.date_format(start, "yyyy-MM-dd")))


@query
def keyed_stream(spark, sf_dir):
    """Moments of every user from a stream that is stopped once; each arriving third holds all days, the last one late."""
    events = table(spark, sf_dir, "events")
    folder = scratch(spark, "keyed")
    value = F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("value")
    rows = events.select("event_id", "ts", "user_id", value)
    for part in range(3):
        rows.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{folder}/in")
        if part:  # two thirds in the first run, the rest after a restart
            arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8).parquet(f"{folder}/in")
            versions = keyed.running_moments(arriving, ["user_id"], "ts", "value")
            keyed.run_available(versions, f"{folder}/table", f"{folder}/checkpoint")
    merged = keyed.merged_moments(spark.read.parquet(f"{folder}/table"), ["user_id"])
    utc = lambda c: F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
    # values have two decimals, so some means lie half way between two rounded ones: these go up in any engine
    merged = merged.withColumn("mean", F.col("mean") + F.lit(1e-9))
    return rounded(merged.withColumns({"first": utc("first"), "last": utc("last"), "repeated": F.col("repeated").cast("int")}))
