"""Readers: database tables, CSV, parquet and GeoJSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.functions.columns import nan_to_null
from mendframe.operators.clean import any_present, project_renamed

# Source columns of the property table, with the names that differ between sources.
PROPERTY_COLUMNS = {
    "id_predio": ["id_predio", "nm_mtcla_prdio"],
    "estrato": ["estrato", "estrato_pre"],
    "barrio_nombre": ["barrio_nombre", "ds_barrio"],
    "avaluo_total": ["avaluo_total", "ava_total_ava"],
    "area_construida": ["area_construida", "area_con"],
    "puntaje": ["puntaje", "nm_ptje"],
    "tipo_construccion": ["tipo_construccion", "ds_tipo_construccion", "ds_tipo_constru"],
}

FEATURE_PROPERTIES = T.StructType(
    [
        T.StructField("nombre", T.StringType()),
        T.StructField("codigo", T.StringType()),
        T.StructField("st_area(shape)", T.DoubleType()),
    ]
)


def feature_schema(properties: T.StructType = FEATURE_PROPERTIES) -> T.StructType:
    """One feature. Geometry is kept as JSON text, which holds polygons and multipolygons alike."""
    return T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("properties", properties),
            T.StructField("geometry", T.StringType()),
        ]
    )


def collection_schema(properties: T.StructType = FEATURE_PROPERTIES) -> T.StructType:
    return T.StructType([T.StructField("features", T.ArrayType(feature_schema(properties)))])


def read_database(
    spark: SparkSession,
    url: str,
    query: str,
    options: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Result of a SELECT over JDBC, read in parallel ranges of a numeric column where one is given.

    Connection options (user, password, driver) come from the caller. Filters and column choices
    made on the result reach the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
    for name, value in database_options(query, partition_column, bounds, partitions).items():
        reader = reader.option(name, value)
    return nan_to_null(reader.options(**options).load())


def database_options(
    query: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 1
) -> dict[str, str]:
    settings = {"dbtable": f"({query.strip().rstrip(';')}) source"}
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        settings |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return settings


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = True) -> DataFrame:
    """CSV with a header and a given schema: nothing is read twice to infer types.

    Padding stays, "" is a blank and an empty field is NULL, doubled quotes are read as one. With
    `line_breaks` a quoted field may hold some, and a file is one task; without, large files split.
    """
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
    # an empty field is read as this mark, which no text holds, and so told apart from a quoted blank
    reader = spark.read.schema(schema).options(**options, nullValue="\u0001null\u0001", multiLine=line_breaks)
    return nan_to_null(reader.csv(path))


def read_metrics(spark: SparkSession, path: str, by: str = "metric string") -> DataFrame:
    """The history that `writers.write_metrics` appends: one row per run and metric."""
    return spark.read.schema(f"{by}, value double, run string").json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def property_rows(df: DataFrame, require_any: Sequence[str] = ()) -> DataFrame:
    """Raw source columns under the property names, optionally only rows with some value present."""
    renamed = project_renamed(df, PROPERTY_COLUMNS)
    return any_present(renamed, require_any) if require_any else renamed


def read_geojson(
    spark: SparkSession, path: str, properties: T.StructType = FEATURE_PROPERTIES, line_delimited: bool = False
) -> DataFrame:
    """Features of GeoJSON files, one row each: the properties, and the geometry as JSON text.

    A FeatureCollection file is one document and one task per file; large inputs come line-delimited
    with one feature per line, which splits.
    """
    if line_delimited:
        features = spark.read.schema(feature_schema(properties)).json(path)
    else:
        documents = spark.read.schema(collection_schema(properties)).option("multiLine", True).json(path)
        features = documents.select(F.inline("features"))
    return flatten_features(features)


def parse_collections(df: DataFrame, text: str, properties: T.StructType = FEATURE_PROPERTIES) -> DataFrame:
    """Features of FeatureCollections held as text in a column."""
    parsed = df.select(F.from_json(F.col(text), collection_schema(properties)).alias("c"))
    return flatten_features(parsed.select(F.inline("c.features")))


def parse_feature_lines(
    df: DataFrame, text: str = "value", properties: T.StructType = FEATURE_PROPERTIES
) -> DataFrame:
    """Features held one per line as text in a column."""
    parsed = df.select(F.from_json(F.col(text), feature_schema(properties)).alias("f"))
    return flatten_features(parsed.select("f.*"))


def flatten_features(features: DataFrame) -> DataFrame:
    return features.select("properties.*", "geometry")


def first_vertex(geometry: str) -> tuple[Column, Column]:
    """Longitude and latitude of the first vertex of a polygon held as JSON text."""
    point = "$.coordinates[0][0]"
    return (
        F.get_json_object(F.col(geometry), f"{point}[0]").try_cast("double").alias("lon"),
        F.get_json_object(F.col(geometry), f"{point}[1]").try_cast("double").alias("lat"),
    )
