"""Shapes held as GeoJSON text: area, centroid, and which shape a point lies in.

A geometry is an array of polygons, a polygon an array of rings (the outer one first, then holes), a ring an array of
[x, y]; whether a ring repeats its first vertex at the end makes no difference. Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendframe.functions.columns import quoted
from mendframe.session import materialized

POLYGON = "array<array<array<double>>>"
#: A cell with more places than this is dealt over parts of about so many; only shapes in such cells are copied to the parts.
HOT_CELL = 10000
#: Cells have an edge of 2^level; shapes beyond these sizes use the last level.
LEVELS = (-40, 60)


def polygons(geometry: Column) -> Column:
    """The polygons of a Polygon or MultiPolygon held as JSON text.

    Null for other types, text that does not parse, and shapes with an empty polygon, a ring of fewer than three
    vertices or a vertex without two numbers.
    """
    kind, coordinates = F.get_json_object(geometry, "$.type"), F.get_json_object(geometry, "$.coordinates")
    found = F.when(kind == "Polygon", F.array(F.from_json(coordinates, POLYGON))).when(
        kind == "MultiPolygon", F.from_json(coordinates, f"array<{POLYGON}>")
    )
    vertex = lambda v: (F.size(v) >= 2) & v[0].isNotNull() & v[1].isNotNull()
    ring = lambda r: (F.size(r) >= 3) & F.forall(r, vertex)
    polygon = lambda p: (F.size(p) >= 1) & F.forall(p, ring)
    return F.when((F.size(found) >= 1) & F.forall(found, polygon), found)


def _edges(ring: Column) -> Column:
    """Pairs (from, to) of vertices, the last one leading back to the first."""
    shifted = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.zip_with(ring, shifted, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _moments(ring: Column) -> Column:
    """Twice the signed area of a ring and six times its first moments, by the shoelace rule about its first vertex."""
    x0, y0 = ring[0][0], ring[0][1]
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(total: Column, e: Column) -> Column:
        ax, ay, bx, by = e["a"][0] - x0, e["a"][1] - y0, e["b"][0] - x0, e["b"][1] - y0
        cross = ax * by - bx * ay
        return F.struct(
            (total["s"] + cross).alias("s"), (total["x"] + (ax + bx) * cross).alias("x"), (total["y"] + (ay + by) * cross).alias("y")
        )

    return F.aggregate(_edges(ring), zero, add)


def measures(shape: Column) -> Column:
    """Area and centroid (area, x, y) of polygons: outer rings less their holes, whichever way rings turn.

    A shape without area has no centroid; null has no measures.
    """

    def signed(ring: Column, i: Column) -> Column:
        m, side = _moments(ring), F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        turn = side * F.signum(m["s"])
        return F.struct(
            (turn * m["s"] / 2).alias("s"),
            (turn * (m["x"] / 6 + ring[0][0] * m["s"] / 2)).alias("x"),
            (turn * (m["y"] / 6 + ring[0][1] * m["s"] / 2)).alias("y"),
        )

    parts = F.flatten(F.transform(shape, lambda p: F.transform(p, signed)))
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    add = lambda t, m: F.struct(*[(t[c] + m[c]).alias(c) for c in "sxy"])
    done = lambda t: F.struct(
        t["s"].alias("area"), F.try_divide(t["x"], t["s"]).alias("x"), F.try_divide(t["y"], t["s"]).alias("y")
    )
    return F.aggregate(parts, zero, add, done)


def contains(shape: Column, x: Column, y: Column) -> Column:
    """Whether a point lies inside: a ray to the right crosses the rings an odd number of times.

    Of a border, left and lower edges belong to the shape, right and upper ones do not, so shapes that
    share a border share no point.
    """

    def crossed(e: Column) -> Column:
        ax, ay, bx, by = e["a"][0], e["a"][1], e["b"][0], e["b"][1]
        side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        return F.when(by > ay, (ay <= y) & (y < by) & (side > 0)).otherwise((by <= y) & (y < ay) & (side < 0))

    rings = F.flatten(shape)
    return F.aggregate(rings, F.lit(0), lambda n, r: n + F.size(F.filter(_edges(r), crossed))) % 2 == 1


def _level(width: Column) -> Column:
    exact = F.ceil(F.log2(F.greatest(width, F.lit(2.0 ** LEVELS[0]))))
    return F.least(F.greatest(exact, F.lit(LEVELS[0])), F.lit(LEVELS[1])).cast("int")


def attach_by_location(
    points: DataFrame, shapes: DataFrame, x: str, y: str, shape_id: str, geometry: str, out: str = "shape", matches: str = "shapes",
    hot_cell: int = HOT_CELL,
) -> DataFrame:
    """`points` with the smallest id of the shapes that contain each, and how many shapes do (`out`, `matches`).

    A shape is indexed by the cells of a grid whose edge is the power of two next to its own size, so it
    has about four cells whether it is a house or a country; a point has one cell for each grid in use. Points meet
    shapes by equal cells, those with more than `hot_cell` places in parts; then the shape's box is compared, and only then
    is the shape looked at. Equal points are one until the end. Rows without
    coordinates, NaN among them, lie in no shape; shapes without an id or with unreadable geometry are left out; several rows
    of one id are one shape for `out` and each count for `matches`. The driver sees the levels in use, 101 at most.
    """
    read = shapes.select(quoted(shape_id).alias("id"), polygons(quoted(geometry)).alias("shape")).where("id is not null and shape is not null")
    outer = F.flatten(F.flatten("shape"))
    box = read.withColumns({"xs": F.transform(outer, lambda v: v[0]), "ys": F.transform(outer, lambda v: v[1])}).select(
        "id", "shape", *[f(c).alias(f"{n}_{c}") for c in ("xs", "ys") for n, f in (("low", F.array_min), ("high", F.array_max))]
    )
    box = box.withColumn("level", _level(F.greatest(F.col("high_xs") - F.col("low_xs"), F.col("high_ys") - F.col("low_ys"))))
    box = materialized(box, "shapes")  # the text is parsed once, for the levels and for the cells
    levels = sorted(r["level"] for r in box.select("level").distinct().collect())
    cell = lambda c, level: F.floor(c / F.pow(F.lit(2.0), level))
    spans = [F.explode(F.sequence(cell(F.col(f"low_{c}"), F.col("level")), cell(F.col(f"high_{c}"), F.col("level")))) for c in ("xs", "ys")]
    # a filter on the box leaves a few candidates of the many shapes that share a cell with a point
    bounds = ["low_xs", "high_xs", "low_ys", "high_ys"]
    cells = box.withColumn("cx", spans[0]).withColumn("cy", spans[1]).select("id", "shape", "level", "cx", "cy", *bounds)
    # -0.0 and 0.0 are one coordinate for joins and groups alike
    px, py = (quoted(c).cast("double") + F.lit(0.0) for c in (x, y))
    places = points.select(px.alias("px"), py.alias("py")).where("px is not null and py is not null and not isnan(px) and not isnan(py)").distinct()
    wanted = F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<int>")
    places = places.withColumn("level", F.explode(wanted)).withColumns({"cx": cell(F.col("px"), F.col("level")), "cy": cell(F.col("py"), F.col("level"))})
    hot = places.groupBy("level", "cx", "cy").agg(F.count("*").alias("n")).where(F.col("n") > hot_cell)
    parts = hot.select("level", "cx", "cy", F.ceil(F.col("n") / hot_cell).cast("int").alias("parts"))
    # fewer rows than places / hot_cell per level, so they are sent to all tasks; shapes, grown by their cells, never are
    part = F.coalesce(F.pmod(F.xxhash64("px", "py"), F.col("parts")), F.lit(0)).cast("int")
    places = places.join(F.broadcast(parts), ["level", "cx", "cy"], "left").withColumn("part", part).drop("parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))
    cells = cells.join(F.broadcast(parts), ["level", "cx", "cy"], "left").withColumn("part", copies).drop("parts")
    met = places.join(cells.hint("merge"), ["level", "cx", "cy", "part"])
    boxed = F.col("px").between(F.col("low_xs"), F.col("high_xs")) & F.col("py").between(F.col("low_ys"), F.col("high_ys"))
    found = met.where(boxed).where(contains(F.col("shape"), F.col("px"), F.col("py")))
    found = found.groupBy("px", "py").agg(F.min("id").alias("_id"), F.count("*").alias("_n"))
    kept = [c for c in points.columns if c not in (out, matches)]
    named = {c: f"c{i}" for i, c in enumerate(kept)}
    rows = points.select(*[quoted(c).alias(n) for c, n in named.items()], px.alias("px"), py.alias("py"))
    joined = rows.join(found, ["px", "py"], "left")
    return joined.select(*named.values(), "_id", F.coalesce("_n", F.lit(0)).cast("long").alias("_n")).toDF(*kept, out, matches)
