import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mendframe.operators.dependencies import functional_dependencies

COLUMNS = ["city", "zip code", "kind", "noise"]


def brute(rows, most, tolerance):
    out, found = {}, []
    for size in range(1, most + 1):
        for left in itertools.combinations(range(4), size):
            for right in set(range(4)) - set(left):
                if any(r == right and set(p) <= set(left) and len(p) < size for p, r in found):
                    continue
                groups = {}
                for row in rows:
                    groups.setdefault(tuple(row[i] for i in left), Counter())[row[right]] += 1
                bad = sum(sum(c.values()) - max(c.values()) for c in groups.values())
                out[tuple(COLUMNS[i] for i in left), COLUMNS[right]] = (len(groups), bad, 100 * bad / len(rows) <= tolerance)
                if 100 * bad / len(rows) <= tolerance:
                    found.append((left, right))
    return out


@pytest.mark.parametrize(("most", "tolerance"), [(1, 0.0), (2, 0.0), (3, 2.0)])
def test_equals_brute_force(spark, most, tolerance):
    rows = []
    for i in range(400):
        z = 0 if i % 3 == 0 else i % 19  # a third of the rows share one code
        rows.append(("x" if i % 97 == 0 else f"c{z // 4}", None if z == 5 else z, (z + i % 2) % 3 if z else None, i * 7 % 11))
    df = spark.createDataFrame(rows, "city string, `zip code` int, kind int, noise int").repartition(7)
    found = functional_dependencies(df, COLUMNS, most, tolerance).collect()
    got = {(tuple(r["determinant"]), r["dependent"]): (r["groups"], r["violations"], r["holds"]) for r in found}
    assert got == brute(rows, most, tolerance) and len(got) == len(found)


def test_odd_tables(spark):
    df = spark.range(3).select("id", F.lit(None).cast("int").alias("none"))
    got = {(r["determinant"][0], r["dependent"]): r["violations"] for r in functional_dependencies(df, ["id", "none"]).collect()}
    assert got == {("id", "none"): 0, ("none", "id"): 2}
    assert functional_dependencies(df.limit(0), ["id", "none"]).count() == 0
    assert functional_dependencies(df, ["id"]).count() == 0
    with pytest.raises(ValueError):
        functional_dependencies(df, ["id", "id"])
