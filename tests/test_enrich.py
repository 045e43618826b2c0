import json

import pytest
from pyspark.sql import functions as F

from mendframe.functions import buckets
from mendframe.operators import enrich
from mendframe.plans.neighbourhoods import enrich_neighbourhoods, enrich_with_facts
from mendframe.sources import readers, writers


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame(
        [
            ("el poblado ", "9901", 200_000.0),  # name hit in another case, with a trailing blank
            ("Nowhere", "1405", 50_000.0),  # name miss, district hit
            ("Nowhere", "9905", 300_000.0),  # double miss
            ("LAURELES", "1101", None),  # missing area
            ("POPULAR", "0101", 10.0),  # tiny area: the floor applies
            (None, None, 100_000.0),
        ],
        "nombre string, codigo string, `st_area(shape)` double",
    )


def test_two_tier_lookup_scaling_and_class(features):
    rows = enrich_neighbourhoods(features).orderBy("area").collect()
    by_area = {r["area"]: r for r in rows}
    poblado = by_area[200_000.0]
    assert (poblado["tier"], poblado["stratum"], poblado["row_count"]) == (1, 6, 3000)
    assert poblado["total_value"] == 3000 * 450_000_000 and poblado["average_value"] == 450_000_000
    assert poblado["density"] == 3000 / 0.2 and poblado["prestige"] == "PREMIUM"
    district = by_area[50_000.0]
    assert (district["tier"], district["stratum"], district["base_count"], district["base_value"]) == (2, 6, 640, 375_000_000)
    miss = by_area[300_000.0]
    assert (miss["tier"], miss["stratum"], miss["row_count"], miss["base_value"]) == (0, 2, 1500, 150_000_000)
    assert by_area[10_000.0]["row_count"] == 120  # default area
    assert by_area[10.0]["row_count"] == 50
    assert by_area[100_000.0]["tier"] == 0


def test_matched_row_wins_even_with_null_attributes(spark):
    df = spark.createDataFrame([("a", "zz")], "n string, c string")
    tier1 = spark.createDataFrame([("A", None)], "name string, x int")
    tier2 = spark.createDataFrame([("zz", 5)], "code string, x int")
    assert enrich.lookup_two_tier(df, "n", "c", tier1, tier2, {"x": 9}).first()["x"] is None


def test_classes_by_stratum_and_value(spark):
    cases = [(5, 0), (1, 300_000_000), (4, 0), (1, 250_000_000), (3, 0), (2, 200_000_000), (2, 0), (1, 150_000_000), (1, 0), (None, None)]
    df = spark.createDataFrame(cases, "s int, v bigint")
    got = [tuple(r) for r in df.select(buckets.prestige_label(F.col("s"), F.col("v")), buckets.prestige_score(F.col("s"), F.col("v"))).collect()]
    labels = ["PREMIUM", "PREMIUM", "ALTO", "ALTO", "MEDIO ALTO", "MEDIO ALTO", "MEDIO", "MEDIO", "BAJO", "BAJO"]
    assert [g[0] for g in got] == labels
    assert [g[1] for g in got] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]


def test_state_and_colour_bounds(spark):
    df = spark.createDataFrame([(v,) for v in (90.0, 89.999, 75.0, 60.0, 59.9, None)], "v double")
    assert [r[0] for r in df.select(buckets.quality_state(F.col("v"))).collect()] == [
        "EXCELENTE", "BUENA", "BUENA", "ACEPTABLE", "CRÍTICA", None,
    ]
    shares = spark.createDataFrame([(v,) for v in (79.9, 80.0, 95.0)], "v double")
    assert [r[0] for r in shares.select(buckets.completeness_colour(F.col("v"))).collect()] == ["red", "orange", "green"]


def test_class_summary_shows_empty_classes_in_order(spark):
    static = enrich.classify(enrich.static_neighbourhoods(spark), "stratum", "average_value")
    summary = enrich.class_summary(static, "prestige", {"rows": F.col("row_count")}).collect()
    assert [r["label"] for r in summary] == ["PREMIUM", "ALTO", "MEDIO ALTO", "MEDIO", "BAJO"]
    assert sum(r["members"] for r in summary) == 20
    none = enrich.class_summary(static.filter("prestige = 'ALTO'"), "prestige").collect()
    assert [r["members"] for r in none] == [0, summary[1]["members"], 0, 0, 0]


def test_group_mean_counts_rows_without_a_measure(spark):
    df = spark.createDataFrame([("g", "1", 10.0), ("g", "2", None), ("g", None, 2.0)], "g string, id string, v double")
    r = enrich.group_totals(df, "g", "id", "v").first()
    assert (r["row_count"], r["total_value"], r["average_value"]) == (2, 12.0, 6.0)


def test_heat_points_do_not_depend_on_chunks(spark):
    df = spark.createDataFrame([("a", 1234, 5, 6.0, -75.0), ("b", 99, 1, 6.0, -75.0)], "n string, c bigint, s int, lat double, lon double")
    small, large = (
        sorted(map(tuple, enrich.heat_points(df, "n", "c", "s", "lat", "lon", chunk=size).collect())) for size in (5, 4096)
    )
    assert small == large and len(small) == 12 and {r[4] for r in small} == {1.0}


def test_facts_meet_features_by_normalised_name(spark, features):
    facts = spark.createDataFrame(
        [("El Poblado", "1", 100.0, 50.0), (" EL POBLADO", "2", 300.0, 150.0), ("Other", "3", 1.0, 1.0)],
        "b string, id string, v double, a double",
    )
    enriched = enrich_with_facts(enrich_neighbourhoods(features), facts, "nombre", "b", "id", "v", "a")
    hit = enriched.filter("tier = 1 and stratum = 6").first()
    assert (hit["fact_rows"], hit["fact_value"], hit["fact_mean_area"]) == (2, 400.0, 100.0)
    assert hit["value_per_m2"] == 450_000_000 / 100.0
    assert enriched.count() == features.count()
    missing = enrich.unmatched_groups(features, "nombre", facts, "b", "id", "v", "a")
    assert [r["name"] for r in missing.collect()] == ["OTHER"]


def test_geojson_collection_and_lines(spark, tmp_path, features):
    collection = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "properties": {"nombre": "A", "codigo": "01"}, "geometry": {"type": "Polygon", "coordinates": [[[-75.5, 6.25], [0, 0]]]}},
            {"type": "Feature", "properties": {"nombre": "B", "codigo": "02", "st_area(shape)": 5.5}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[1, 2]]]]}},
        ],
    }
    (tmp_path / "in.geojson").write_text(json.dumps(collection, indent=1), encoding="utf-8")
    read = readers.read_geojson(spark, str(tmp_path / "in.geojson"))
    assert [r["nombre"] for r in read.orderBy("nombre").collect()] == ["A", "B"]
    first = read.filter("nombre = 'A'").select(*readers.first_vertex("geometry")).first()
    assert tuple(first) == (-75.5, 6.25)
    writers.write_geojson_lines(read, str(tmp_path / "out"))
    again = readers.read_geojson(spark, str(tmp_path / "out"), line_delimited=True)
    plain = lambda df: sorted((*r[:3], str(json.loads(r[3]))) for r in df.fillna(0.0).collect())
    assert plain(again) == plain(read)
    text = spark.createDataFrame([(json.dumps(collection),)], "doc string")
    assert readers.parse_collections(text, "doc").count() == 2
    assert readers.parse_feature_lines(writers.feature_lines(read)).count() == 2


def test_csv_metrics_and_database_options(spark, tmp_path):
    df = spark.createDataFrame([("a,1", 1.5), (None, None)], "s string, x double")
    writers.write_csv(df, str(tmp_path / "csv"))
    assert sorted(map(str, readers.read_csv(spark, str(tmp_path / "csv"), df.schema).collect())) == sorted(map(str, df.collect()))
    metrics = spark.createDataFrame([("m", 1.0)], "metric string, value double")
    for run in ("r1", "r2"):
        writers.write_metrics(metrics, str(tmp_path / "metrics"), run)
    assert spark.read.json(str(tmp_path / "metrics")).count() == 2
    options = readers.database_options("SELECT a FROM t;", "a", (0, 100), 8)
    assert options["dbtable"] == "(SELECT a FROM t) source" and options["numPartitions"] == "8"
    with pytest.raises(ValueError):
        readers.database_options("SELECT 1", "a")
