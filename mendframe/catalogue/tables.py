"""The driver tables, and the view of them with nulls, copies, bad values and mixed-case text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mendframe.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def property_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-column fact table over lineitem and part; one scan and one join, copies by explode."""
    lines = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_returnflag", "l_linestatus",
        )
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey)
    no_building = F.col("l_partkey") % 24 == 0
    return joined.select(
        F.when(F.col("l_orderkey") % 211 != 0, F.col("l_orderkey").cast("string")).alias("id_predio"),
        (F.col("p_size") % 7).alias("estrato"),
        F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit(" "), F.upper("p_brand"), F.lit("  ")))
        .otherwise(F.col("p_brand"))
        .alias("barrio_nombre"),
        F.when(F.col("l_suppkey") % 53 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("avaluo_total"),
        F.when(no_building, F.lit(None))
        .when(F.col("l_partkey") % 97 == 0, F.lit(0.0))
        .when(F.col("l_partkey") % 101 == 0, F.lit(-1.0))
        .otherwise(F.col("l_quantity") * 3)
        .alias("area_construida"),
        F.when(no_building, F.lit(None))
        .when((F.col("l_linenumber") == 7) & (F.col("l_suppkey") % 10 == 0), F.lit(101.0))
        .otherwise(F.round(F.col("l_discount") * 100) * 10)
        .alias("puntaje"),
        F.when(no_building, F.lit(None))
        .when(F.col("l_quantity") > 48, F.lit(" "))
        .when((F.col("l_linestatus") == "F") & (F.col("l_quantity") < 3), F.lower("l_returnflag"))
        .otherwise(F.col("l_returnflag"))
        .alias("tipo_construccion"),
        F.explode(F.when(F.col("l_partkey") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias(
            "copy"
        ),
    ).drop("copy")
