import json
import math
import random

import pytest
from pyspark.sql import functions as F

from mendframe.catalogue import oracles, queries
from mendframe.operators import geometry

SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4]]
HOLE = [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]


def inside(polygons, x, y):
    odd = False
    for ring in (r for p in polygons for r in p):
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay <= y) != (by <= y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                odd = not odd
    return odd


def text(polygons):
    return json.dumps({"type": "MultiPolygon", "coordinates": polygons})


def test_measures(spark):
    rows = [
        (1, json.dumps({"type": "Polygon", "coordinates": [SQUARE]})),
        (2, json.dumps({"type": "Polygon", "coordinates": [[*SQUARE[::-1], SQUARE[3]], HOLE]})),
        (3, text([[SQUARE], [[[10, 10], [12, 10], [10, 13]]]])),
        (4, json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [2, 2]]]})),
        (5, json.dumps({"type": "Point", "coordinates": [1, 2]})),
        (6, json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, None], [2, 2]]]})),
        (7, json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, 1]]]})),
        (8, json.dumps({"type": "Polygon", "coordinates": []})),
        (9, "not json"),
        (10, None),
    ]
    df = spark.createDataFrame(rows, "id int, g string").select("id", geometry.measures(geometry.polygons(F.col("g"))).alias("m"))
    got = {r["id"]: tuple(r["m"]) if r["m"] else None for r in df.collect()}
    assert got[1] == (16.0, 2.0, 2.0)
    assert got[2] == pytest.approx((15.0, (32 - 1.5) / 15, (32 - 1.5) / 15))
    assert got[3] == pytest.approx((19.0, (32 + 3 * 32 / 3) / 19, (32 + 3 * 11) / 19))
    assert got[4] == (0.0, None, None)
    assert all(got[i] is None for i in range(5, 11))


def test_location_against_brute_force(spark):
    rnd = random.Random(4)
    shapes = []
    for i in range(60):
        size, cx, cy = rnd.choice([0.01, 0.5, 3, 40]), rnd.uniform(-50, 50), rnd.uniform(-50, 50)
        angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(7))
        ring = lambda f: [[cx + f * size * math.cos(a), cy + f * size * math.sin(a)] for a in angles]  # noqa: E731,B023
        shapes.append((i, [[ring(1.0), ring(0.4)], [[[v[0] + 3 * size, v[1]] for v in ring(0.5)]]]))
    points = [(i, rnd.uniform(-60, 60), rnd.uniform(-60, 60)) for i in range(600)]
    points += [(1000 + i, 3.0, 4.0) for i in range(400)] + [(2000, None, 1.0), (2001, float("nan"), 1.0), (2002, 1e9, 1.0), (2003, -0.0, 0.0)]
    frame = spark.createDataFrame([(i, text(p)) for i, p in shapes] + [(None, text(shapes[0][1])), (99, None)], "k int, g string")
    places = spark.createDataFrame([(i, x, y, "own") for i, x, y in points], "id int, x double, y double, level string")
    found = geometry.attach_by_location(places, frame, "x", "y", "k", "g")
    assert found.columns == ["id", "x", "y", "level", "shape", "shapes"]
    got = {r["id"]: (r["shape"], r["shapes"]) for r in found.collect()}
    assert len(got) == len(points) == found.count()
    for i, x, y in points:
        hits = [k for k, p in shapes if x is not None and not math.isnan(x) and inside(p, x, y)]
        assert got[i] == (min(hits, default=None), len(hits)), i
    assert sum(n > 1 for _, n in got.values()) > 20


def test_shared_borders_and_empty_tables(spark):
    cells = [(10 * i + j, text([[[[i, j], [i + 1, j], [i + 1, j + 1], [i, j + 1]]]])) for i in range(4) for j in range(4)]
    shapes = spark.createDataFrame(cells, "k int, g string")
    grid = spark.createDataFrame([(i / 2, j / 2) for i in range(8) for j in range(8)], "x double, y double")
    found = geometry.attach_by_location(grid, shapes, "x", "y", "k", "g")
    assert found.where("shapes <> 1 or shape <> 10 * floor(x) + floor(y)").count() == 0 and found.count() == 64
    assert geometry.attach_by_location(grid, shapes.limit(0), "x", "y", "k", "g").where("shapes = 0 and shape is null").count() == 64
    assert geometry.attach_by_location(grid.limit(0), shapes, "x", "y", "k", "g").count() == 0


def test_shapes_are_never_broadcast_and_hot_cells_are_dealt(spark):
    """A small table of shapes grows by its cells and is not sent to every task; parts of a hot cell change nothing."""
    shapes = spark.createDataFrame([(k, text([[[[0, 0], [4 + k, 0], [4 + k, 4], [0, 4]]]])) for k in range(4)], "k int, g string")
    points = spark.range(300).selectExpr("id % 25 * 0.25D AS x", "id div 25 * 0.5D AS y")
    found = geometry.attach_by_location(points, shapes, "x", "y", "k", "g", hot_cell=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [level" in plan
    assert found.count() == 300
    for r in found.collect():
        hits = [k for k in range(4) if r["x"] < 4 + k and r["y"] < 4]
        assert (r["shape"], r["shapes"]) == (min(hits, default=None), len(hits))


@pytest.mark.parametrize("name", ["shape_measures", "located_customers"])
def test_queries_equal_their_sql(spark, name):
    """The SQL of both is plain enough to run in Spark too."""
    sf = "/root/testdata/sf0.001"
    for t in ("part", "customer"):
        spark.read.parquet(f"{sf}/{t}.parquet").createOrReplaceTempView(t)
    ours = queries.REGISTRY[name](spark, sf)
    theirs = spark.sql(oracles.build()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    rows = [sorted(tuple(r) for r in df.select(*sorted(ours.columns)).collect()) if name == "shape_measures" else
            sorted(str(tuple(r)) for r in df.select(*sorted(ours.columns)).collect()) for df in (ours, theirs)]
    assert rows[0] == rows[1] and len(rows[0]) > 100
