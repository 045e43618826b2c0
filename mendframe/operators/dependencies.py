"""Rules found from data: which columns determine which, and in how many rows they fail to.

Rows fold to counted combinations once. A determinant set splits them into groups; the rows outside the commonest
dependent value of their group are the violations, the fewest rows whose removal makes the dependency hold. Sets
grow by one column a level, and only where no smaller set already determines the dependent.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendframe.functions.columns import quoted
from mendframe.functions.numeric import percent
from mendframe.session import temporary

SCHEMA = "determinant array<string>, dependent string, groups bigint, violations bigint, percent double, holds boolean"


def functional_dependencies(df: DataFrame, columns: Sequence[str], most: int = 2, tolerance: float = 0.0) -> DataFrame:
    """Candidate dependencies among `columns` with up to `most` determinants, their violations and whether they hold.

    `holds`: at most `tolerance` percent of the rows violate it. A set is left out where a part of it
    already determines the dependent. A null is a value like any other; a table without rows has no candidates.
    The driver sees one row a candidate.
    """
    if len(set(columns)) < len(columns):
        raise ValueError("columns must differ")
    if df.isEmpty():
        return df.sparkSession.createDataFrame([], SCHEMA)
    counted = df.groupBy(*[quoted(c) for c in columns]).agg(F.count("*").alias("_n"))
    found, rows = [], []
    with temporary(counted.toDF(*[f"c{i}" for i in range(len(columns))], "n"), "combinations") as folded:
        for size in range(1, most + 1):
            candidates = [
                (left, right)
                for left in itertools.combinations(range(len(columns)), size)
                for right in range(len(columns))
                if right not in left and not any(r == right and set(part) <= set(left) for part, r in found)
            ]
            if not candidates:
                break
            for r in _violations(folded, candidates, tolerance).collect():
                left, right = candidates[r["id"]]
                rows.append(([columns[i] for i in left], columns[right], r["groups"], r["violations"], r["percent"], r["holds"]))
                if r["holds"]:
                    found.append((left, right))
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def _violations(folded: DataFrame, candidates: Sequence[tuple[tuple[int, ...], int]], tolerance: float) -> DataFrame:
    """All candidates of a level from one scan; counts are summed before every shuffle, so a hot group is one row a task."""
    text = lambda i: F.col(f"c{i}").cast("string")
    cells = [
        F.struct(F.lit(k).alias("id"), F.array(*[text(i) for i in left]).alias("left"), text(right).alias("right"))
        for k, (left, right) in enumerate(candidates)
    ]
    pairs = folded.select("n", F.explode(F.array(*cells)).alias("c")).groupBy("c.id", "c.left", "c.right").agg(F.sum("n").alias("n"))
    groups = pairs.groupBy("id", "left").agg(F.sum("n").alias("n"), F.max("n").alias("top"))
    sums = groups.groupBy("id").agg(
        F.count("*").alias("groups"), F.sum(F.col("n") - F.col("top")).alias("violations"), F.sum("n").alias("_rows")
    )
    share = percent(F.col("violations"), F.col("_rows"))
    return sums.select("id", "groups", "violations", share.alias("percent"), (share <= tolerance).alias("holds"))
