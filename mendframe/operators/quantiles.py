"""Exact order statistics and linear-interpolated quantiles without gathering a column in one task.

A round brackets every wanted rank between two values by approximate percentiles (one scan) and counts
the rows below, at and between them (one scan). The rank then stands at one of the two values or
between them, where only a few rows in ACCURACY are left, whatever the distribution: three rounds serve
10^11 rows. Once few rows are left in a bracket, its distinct values are counted and ordered. Counting
combines on the map side, so a value held by a third of the rows costs one group.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendframe.functions.columns import quoted

MAX_RANGE_ROWS = 100_000
ACCURACY = 10_000
RANGES_PER_SCAN = 100


@dataclass(frozen=True)
class Range:
    """The `inside` values of a series strictly between `low` and `high` (None: no bound), ranked from `below`."""

    name: str
    rank: int
    below: int
    inside: int
    low: object = None
    high: object = None
    stuck: bool = False

    def values(self, series: Column) -> Column:
        held = series.isNotNull()
        if self.low is not None:
            held = held & (series > F.lit(self.low))
        if self.high is not None:
            held = held & (series < F.lit(self.high))
        return F.when(held, series)


def order_statistics(
    df: DataFrame,
    series: Mapping[str, Column],
    ranks: Mapping[str, Sequence[int]],
    sizes: Mapping[str, int],
    max_rows: int = MAX_RANGE_ROWS,
) -> dict[tuple[str, int], object]:
    """Values at 0-based ranks of the non-null values of numeric series of one type.

    A series is a column or an expression over the row, without NaN (`present`); `sizes` holds its
    number of non-null values. All series share each scan.
    """
    todo = [Range(name, k, 0, sizes[name]) for name in series for k in sorted(set(ranks[name])) if 0 <= k < sizes[name]]
    found: dict[tuple[str, int], object] = {}
    while wide := [r for r in todo if r.inside > max_rows and not r.stuck]:
        todo = [r for r in todo if r not in wide]
        for at in range(0, len(wide), RANGES_PER_SCAN):
            for r in _narrowed(df, series, wide[at : at + RANGES_PER_SCAN]):
                if isinstance(r, Range):
                    todo.append(r)
                else:
                    found[r[0]] = r[1]
    for at in range(0, len(todo), RANGES_PER_SCAN):
        found |= _counted(df, series, todo[at : at + RANGES_PER_SCAN])
    return found


def _narrowed(df: DataFrame, series: Mapping[str, Column], ranges: Sequence[Range]) -> list:
    """For every range the narrower one that holds its rank, or its key and the value found."""
    margin, wanted = 2 / ACCURACY, {}
    for r in ranges:
        share = (r.rank - r.below) / r.inside
        wanted.setdefault((r.name, r.low, r.high), []).extend(s for s in (share - margin, share + margin) if 0 < s < 1)
    # one sketch for all ranks of a series between the same bounds
    ends, first = [], {(r.name, r.low, r.high): r for r in ranges}
    for i, (group, shares) in enumerate(wanted.items()):
        values = first[group].values(series[group[0]])
        ends += [F.min(values).alias(f"min{i}"), F.max(values).alias(f"max{i}")]
        if shares:
            ends.append(F.percentile_approx(values, sorted(set(shares)), ACCURACY).alias(f"at{i}"))
    row, bounds = df.agg(*ends).first().asDict(), {}
    at = {group: (i, dict(zip(sorted(set(shares)), row.get(f"at{i}") or [], strict=False))) for i, (group, shares) in enumerate(wanted.items())}
    for i, r in enumerate(ranges):
        share, (k, found) = (r.rank - r.below) / r.inside, at[(r.name, r.low, r.high)]
        bounds[f"low{i}"] = found[share - margin] if share > margin else row[f"min{k}"]
        bounds[f"high{i}"] = found[share + margin] if share + margin < 1 else row[f"max{k}"]
    counts = []
    for i, r in enumerate(ranges):
        values, low, high = r.values(series[r.name]), F.lit(bounds[f"low{i}"]), F.lit(bounds[f"high{i}"])
        for name, holds in {
            "under": values < low, "low": values == low, "between": (values > low) & (values < high), "high": (values == high) & (high != low)
        }.items():
            counts.append(F.count_if(holds).alias(f"n {name}{i}"))
    n = df.agg(*counts).first()
    result = []
    for i, r in enumerate(ranges):
        low, high, place = bounds[f"low{i}"], bounds[f"high{i}"], r.rank - r.below
        steps = [n[f"n {name}{i}"] for name in ("under", "low", "between", "high")]
        steps.append(r.inside - sum(steps))
        outcomes = [(r.low, low), None, (low, high), None, (high, r.high)]
        before = 0
        for j, step in enumerate(steps):
            if place < before + step:
                if outcomes[j] is None:
                    result.append(((r.name, r.rank), low if j == 1 else high))
                else:
                    # whole numbers beyond a double's digits may not part any further: few are left then
                    inner = replace(r, low=outcomes[j][0], high=outcomes[j][1], below=r.below + before, inside=step)
                    result.append(replace(inner, stuck=step == r.inside))
                break
            before += step
    return result


def _counted(df: DataFrame, series: Mapping[str, Column], ranges: Sequence[Range]) -> dict[tuple[str, int], object]:
    """The values at the ranks of ranges with few rows, from the counts of their distinct values."""
    alike: dict[tuple, list[Range]] = {}
    for r in ranges:
        alike.setdefault((r.name, r.low, r.high), []).append(r)
    groups = list(alike.values())
    if not groups:
        return {}
    entries = F.array(
        *[F.struct(F.lit(i).alias("range"), g[0].values(series[g[0].name]).alias("value")) for i, g in enumerate(groups)]
    )
    cells = (
        df.select(F.inline(F.filter(entries, lambda e: e["value"].isNotNull()))).groupBy("range", "value").agg(F.count("*").alias("n"))
    )
    running = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    counted = cells.withColumn("upto", F.sum("n").over(running))
    wanted = F.lit(False)
    for i, g in enumerate(groups):
        for place in {r.rank - r.below for r in g}:
            wanted = wanted | ((F.col("range") == i) & (F.col("upto") > place) & (F.col("upto") - F.col("n") <= place))
    found = {}
    for row in counted.filter(wanted).collect():
        for r in groups[row["range"]]:
            if row["upto"] - row["n"] <= r.rank - r.below < row["upto"]:
                found[(r.name, r.rank)] = row["value"]
    return found


def present(column: Column) -> Column:
    """The value as a double, NaN as NULL; infinities stay and rank outside all other values."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


def exact_quantiles(
    df: DataFrame,
    probabilities: Mapping[str, Sequence[float]],
    sizes: Mapping[str, int] | None = None,
    series: Mapping[str, Column] | None = None,
    max_rows: int = MAX_RANGE_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbouring ranks, NULLs and NaN left out.

    Names are columns unless `series` gives an expression for each.
    """
    if not probabilities:
        return {}
    values = {
        name: present(series[name] if series else quoted(name)) for name in probabilities
    }
    if sizes is None:
        sizes = df.agg(*[F.count(c).alias(name) for name, c in values.items()]).first().asDict()
    ranks = {}
    for name, wanted in probabilities.items():
        positions = [(sizes[name] - 1) * p for p in wanted] if sizes[name] else []
        ranks[name] = [r for h in positions for r in (math.floor(h), math.ceil(h))]
    at = order_statistics(df, values, ranks, sizes, max_rows)
    result: dict[str, list[float | None]] = {}
    for name, wanted in probabilities.items():
        result[name] = []
        for p in wanted:
            if not sizes[name]:
                result[name].append(None)
                continue
            h = (sizes[name] - 1) * p
            low, high = at[(name, math.floor(h))], at[(name, math.ceil(h))]
            result[name].append(low if low == high else low + (high - low) * (h - math.floor(h)))
    return result
