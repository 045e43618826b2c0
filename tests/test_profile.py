import pytest
from pyspark.sql import functions as F

from mendframe.operators import duplicates, health, profile
from mendframe.plans.profiling import profile_table

SCHEMA = "id string, n double, c string, m map<string, int>"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            ("a", 1.0, "x", None),
            ("a", 1.0, "x", None),
            ("b", 0.0, "y", None),
            ("c", -2.0, "x", None),
            ("d", 100.0, None, None),
            (None, None, None, None),
            (None, None, None, None),
            (None, None, None, None),
        ],
        SCHEMA,
    ).drop("m")


def one(df):
    return df.first().asDict()


def test_basic_counts_extras_and_members(rows):
    assert one(profile.basic_profile(rows)) == {
        "rows": 8, "columns": 3, "duplicate_extras": 3, "duplicate_members": 5,
    }


def test_map_columns_can_be_grouped(spark):
    df = spark.createDataFrame([("a", 1.0, "x", {"k": 1})] * 2, SCHEMA)
    assert one(profile.basic_profile(df))["duplicate_extras"] == 1


def test_empty_input_gives_null_metrics(spark):
    empty = spark.createDataFrame([], "a string, b double")
    assert one(profile.quality_score(empty)) == {
        "completeness": None, "consistency": None, "score": None, "state": None,
    }
    assert one(health.executive_summary(empty))["completeness"] == 100.0
    assert profile.numeric_profile(empty).count() == 0
    assert [r["null_percent"] for r in profile.null_profile(empty).collect()] == [None, None]


def test_score_modes_differ_in_what_counts_as_duplicate(rows):
    members, extras = one(profile.quality_score(rows)), one(health.dashboard_score(rows))
    assert members["consistency"] == 100 - 100 * 5 / 8
    assert extras["consistency"] == 100 - 100 * 3 / 8
    assert members["state"] == "CRÍTICA"


def test_published_score_arithmetic(spark):
    # 1,154,823 rows of 7 columns with 143,868 null cells and 135 rows in duplicate groups
    counts = spark.createDataFrame(
        [(1_154_823, 7, 143_868, 69, 135)],
        "rows bigint, columns bigint, null_cells bigint, duplicate_extras bigint, duplicate_members bigint",
    )
    assert round(one(profile.score_from_health(counts))["score"], 2) == 98.93


def test_numeric_profile_counts_overlaps_twice(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 10, 10, 11, 11, 12, 12, 13]], "v double")
    r = one(profile.numeric_profile(df))
    assert (r["zeros"], r["outliers"], r["negatives"]) == (1, 1, 0)
    assert r["reliability"] == 100 - 2 / 8 * 100
    assert (r["q25"], r["median"], r["q75"]) == (10.0, 11.0, 12.0)


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(c,) for c in "bbaaccd"], "c string")
    assert [r["value"] for r in profile.top_values(df, k=2).orderBy("rank").collect()] == ["a", "b"]


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, float(i), 2.0 * i, i if i else None) for i in range(5)], "a double, b double, c double, d int")
    found = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(df).collect()}
    assert found[("a", "b")] is None
    assert found[("b", "c")] == pytest.approx(1.0)
    assert found[("b", "d")] == pytest.approx(1.0)
    assert {(r[0], r[1]) for r in profile.high_correlations(df).collect()} == {("b", "c"), ("b", "d"), ("c", "d")}


def test_null_patterns_cover_wide_tables(spark):
    names = [f"c{i}" for i in range(70)]
    df = spark.range(4).select(
        *[F.when((F.col("id") == 0) & (F.lit(i) >= 68), F.lit(None)).otherwise(F.col("id")).alias(c) for i, c in enumerate(names)]
    )
    patterns = {r["pattern"]: r["rows"] for r in profile.null_patterns(df).collect()}
    assert patterns == {"0" * 70: 3, "0" * 68 + "11": 1}
    pairs = profile.null_pairs(df).collect()
    assert [(r["column_a"], r["column_b"], r["both_null"]) for r in pairs] == [("c68", "c69", 1)]


def test_mark_duplicates_flags_hot_cold_and_null_keys(spark):
    keys = ["hot"] * 3000 + ["pair"] * 2 + [None] * 2 + [f"k{i}" for i in range(2000)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int").repartition(4)
    marked = duplicates.mark_duplicates(df, ["k"])
    assert marked.count() == len(keys)
    flagged = marked.filter("is_duplicate = 1").groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in flagged} == {"hot": 3000, "pair": 2, None: 2}


def test_keep_first_does_not_depend_on_partitioning(spark):
    data = [(str(i % 7), float(i % 5) if i % 4 else None, f"t{i % 11}") for i in range(200)] + [(None, 1.0, "z")]
    df = spark.createDataFrame(data, "k string, v double, t string")
    results = [
        sorted(map(tuple, duplicates.keep_first(df.repartition(n), "k", ["-v", "t"]).collect())) for n in (1, 16)
    ]
    assert results[0] == results[1]
    assert len(results[0]) == 7
    for k, v, t in results[0]:
        group = [(r[1], r[2]) for r in data if r[0] == k]
        best = max(x for x, _ in group if x is not None)
        assert v == best and t == min(y for x, y in group if x == best)


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    plan = duplicates.keep_first(df, "k", ["v"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_report_has_all_sections(rows):
    lines = profile_table(rows, "demo").report().collect()
    assert [r["section"] for r in lines] == sorted(r["section"] for r in lines)
    assert {1, 2, 3, 4, 5} <= {r["section"] for r in lines}
    nulls = [r["line"].split(":")[0] for r in lines if r["section"] == 3]
    assert nulls == ["NULLS c", "NULLS id", "NULLS n"]


def test_trend_alerts_and_stage_choice(spark, rows):
    history = spark.createDataFrame([("r1", "score", 50.0), ("r2", "score", 70.0)], "run string, metric string, value double")
    trend = {r["run"]: r["change"] for r in health.quality_trend(history).collect()}
    assert trend == {"r1": None, "r2": 20.0}
    assert [r["run"] for r in health.alerts(history).collect()] == ["r1"]
    assert health.latest_stage(rows, None, None) is rows
    with pytest.raises(ValueError):
        health.stage_comparison({"only": rows})
