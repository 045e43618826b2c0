import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.catalogue.tables import property_table
from mendframe.functions import text
from mendframe.functions.columns import nan_to_null
from mendframe.operators import clean, duplicates, rules
from mendframe.operators.duplicates import table_health
from mendframe.plans.cleaning import clean_table, clean_with_audit
from mendframe.roles import PROPERTY_ROLES, PROPERTY_SCHEMA
from mendframe.sources import readers, writers

SF = "/root/testdata/sf0.001"


def property_frame(spark, rows):
    return spark.createDataFrame(rows, PROPERTY_SCHEMA)


def test_strip_removes_what_python_strips(spark):
    samples = [" a b　", "\x1f\x85x\t\n", "  ", "plain", "​kept​"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    assert [r[0] for r in df.select(text.strip(F.col("s"))).collect()] == [s.strip() for s in samples]


def test_numbers_are_read_whole_or_not_at_all(spark):
    samples = {"5d": None, " 1.5 ": 1.5, "-2e1": -20.0, ".5": 0.5, "": None, "x": None, "1,000": None, "+3.": 3.0}
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    read = {r["s"]: r["v"] for r in df.withColumn("v", text.parse_number(F.col("s"))).collect()}
    assert read == samples


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, y int")
    assert [r["x"] for r in nan_to_null(df).orderBy("y").collect()] == [None, 2.0]


def test_nulls_survive_the_text_cast(spark):
    df = spark.createDataFrame([(None, "1"), (3, None)], "a int, b string")
    typed = clean.coerce_types(df, ["a"], ["b"])
    assert sorted(map(tuple, typed.collect()), key=str) == sorted([(None, 1.0), ("3", None)], key=str)
    changes = {r["column"]: (r["before"], r["after"]) for r in clean.type_changes(df, ["a"], ["b"]).collect()}
    assert changes == {"a": ("int", "string"), "b": ("string", "double")}


def test_schema_counts_values_that_the_type_cannot_hold(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "n string")
    expected = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("m", T.StringType())])
    rows = clean.schema_check(df, expected).select("state", "present", "lost").collect()
    assert [tuple(r) for r in rows] == [("TIPO_INCORRECTO", 2, 1), ("FALTANTE", 0, 0)]
    changes = clean.type_changes(df, [], ["n"]).first()
    assert (changes["present_before"], changes["present_after"]) == (2, 1)


def test_cap_by_a_text_key_over_a_large_table(spark):
    """120,000 rows by a text key, some NULL and many tied: the same rows as a full sort gives."""
    key = F.when(F.col("id") % 1000 != 0, F.concat(F.lit("K"), F.pmod(F.xxhash64("id"), F.lit(40_000)).cast("string")))
    df = spark.range(120_000).select(key.alias("k"), "id").repartition(7)
    want = df.orderBy(F.asc_nulls_last("k"), "id")
    for n in (0, 1, 5_000, 50_000, 119_990, 130_000):
        got = clean.row_cap(df, n, "k", ["id"])
        assert got.count() == min(n, 120_000)
        assert got.exceptAll(want.limit(n)).isEmpty()


def test_csv_keeps_padding_blanks_quotes_and_line_breaks(spark, tmp_path):
    notes = ["  pad ", "", None, 'a "quoted, x" b', "one\ntwo\r\n\nthree", "back\\slash\\\"", "\t", '"', '""', ",", "#x", "null"]
    df = spark.createDataFrame(list(enumerate(notes)), "k int, note string")
    writers.write_csv(df, str(tmp_path / "csv"))
    back = readers.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert {r["k"]: r["note"] for r in back.collect()} == dict(enumerate(notes))
    (tmp_path / "given.csv").write_text('k,note\n1,"say ""a, b"" now"\n2,\n3,""\n4, x \n')
    given = readers.read_csv(spark, str(tmp_path / "given.csv"), df.schema)
    assert {r["k"]: r["note"] for r in given.collect()} == {1: 'say "a, b" now', 2: None, 3: "", 4: " x "}


def test_health_tells_rows_apart_by_null_place_and_value(spark):
    rows = [(None, "a"), ("a", None), ("a", None), (None, None), ("", None), (None, "")]
    health = table_health(spark.createDataFrame(rows, "x string, y string")).first()
    assert (health["rows"], health["duplicate_extras"], health["duplicate_members"], health["null_cells"]) == (6, 1, 2, 7)
    zeros = table_health(spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")).first()
    assert zeros["duplicate_extras"] == 1


def test_null_measure_is_kept_and_non_positive_dropped(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "v double")
    assert sorted(r["v"] or 0 for r in clean.drop_non_positive(df, "v").collect()) == [0, 1.0]


def test_bounds_are_inclusive_and_zero_stays(spark):
    rows = [
        ("a", "1", "x", 1.0, 0.0, 100.0, "r"),
        ("b", "1", "x", 1.0, -1.0, 100.5, "r"),
        ("c", "1", "x", 1.0, 2.0, 0.0, "r"),
        ("d", "1", "x", 0.0, 2.0, -5.0, "r"),
    ]
    df = property_frame(spark, rows)
    repaired = {r["id_predio"]: (r["area_construida"], r["puntaje"]) for r in clean.repair_numbers(df, PROPERTY_ROLES).collect()}
    assert repaired == {"a": (0.0, 100.0), "b": (None, None), "c": (2.0, 0.0)}
    counts = {r["rule"]: r["rows"] for r in clean.number_rule_counts(df, PROPERTY_ROLES).collect()}
    assert counts == {"positive": 1, "in_range": 1, "non_negative": 1, "zero_marked": 1}


def test_schema_check_states(spark):
    df = spark.createDataFrame([("a", 1)], "a string, b int")
    expected = T.StructType(
        [T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())]
    )
    assert [r["state"] for r in clean.schema_check(df, expected).collect()] == ["OK", "TIPO_INCORRECTO", "FALTANTE"]


def test_rename_takes_the_first_candidate_and_reports_missing_ones(spark):
    df = spark.createDataFrame([(1,)], "old int")
    assert clean.project_renamed(df, {"new": ["absent", "old"]}).columns == ["new"]
    with pytest.raises(ValueError, match="absent"):
        clean.project_renamed(df, {"new": "absent"})


def test_row_cap_beyond_the_small_limit(spark):
    df = spark.range(0, 30_000).select((F.col("id") * 7 % 30_000).alias("k"), (F.col("id") % 5).alias("x")).repartition(6)
    doubled = df.unionByName(df)
    capped = clean.row_cap(doubled, 20_001, "k", ["x"])
    assert capped.count() == 20_001
    assert capped.agg(F.max("k"), F.min("k")).first() == (10_000, 0)
    assert clean.row_cap(doubled, 10, "k", ["x"]).count() == 10


def test_key_summary_states(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    r = clean.key_repair_summary(df, "k").first().asDict()
    assert r == {"rows": 5, "null_keys": 2, "distinct_keys": 2, "duplicate_members": 4, "state": "DUPLICADOS_CORREGIDOS"}
    assert clean.key_repair_summary(df, "zzz").first()["state"] == "COLUMNA_NO_ENCONTRADA"


def test_deduplication_precedes_folding(spark):
    rows = [
        ("a", "1", "X ", 1.0, 1.0, 1.0, "R"),
        ("a", "1", "X ", 1.0, 1.0, 1.0, "R"),
        ("b", "0", " x", 2.0, 4.0, None, " "),
        (None, "1", "x", 1.0, 1.0, 1.0, "r"),
    ]
    cleaned = clean_table(property_frame(spark, rows)).orderBy("id_predio").collect()
    assert [r["barrio_nombre"] for r in cleaned] == ["x", "x"]
    assert [r["es_comercial"] for r in cleaned] == [0, 1]
    assert cleaned[1]["avaluo_por_m2"] == 0.5 and cleaned[1]["tipo_construccion"] == ""
    blank = clean_table(property_frame(spark, rows), blank_as_null=True).filter("id_predio = 'b'").first()
    assert blank["tipo_construccion"] is None


def test_audit_invariants(spark):
    raw = property_table(spark, SF)
    result = clean_with_audit(raw)
    audit = {(r["section"], r["metric"]): r["value"] for r in result.audit.collect()}
    assert audit[("duplicates", "rows_after")] == audit[("duplicates", "rows_before")] - audit[("duplicates", "exact_duplicates")]
    dropped = audit[("numbers", "avaluo_total positive")]
    assert audit[("summary", "final_rows")] == audit[("key", "distinct_keys")] - dropped
    assert audit[("summary", "final_columns")] == 12
    assert audit[("summary", "final_duplicates")] == 0
    rows = result.data.count()
    assert rows == audit[("summary", "final_rows")] == clean_table(raw).count()
    assert duplicates.drop_exact_duplicates(result.data).count() == rows


def test_rules_dates_and_near_duplicates(spark):
    df = spark.createDataFrame(
        [(1, "Los Olivos #2", "2020-01-31"), (1, "olivos los 2", "31/01/2020"), (2, "los olivos #2", "31-31-31")],
        "k int, name string, day string",
    )
    groups = rules.near_duplicate_groups(df, ["name"], ["k"]).collect()
    assert [tuple(r) for r in groups] == [(1, "2 los olivos", 2, 2)]
    read = rules.standardize_dates(df, "day", ["yyyy-MM-dd", "dd/MM/yyyy"], "d")
    assert [r[0] for r in read.select(F.date_format("d", "yyyyMMdd")).collect()] == ["20200131", "20200131", None]
    checked = rules.check_rules(df, {"low": F.col("k") < 2, "named": rules.required("name")}).collect()
    assert {r["rule"]: r["violations"] for r in checked} == {"low": 1, "named": 0}
