"""Helpers of the subpackage: stored tables, null-safe keys, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendframe.session import materialized, ship  # noqa: F401

NULL_KEY = 2**63 - 1
CHUNK = 1 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a parquet table in the shared checkpoint folder, read back (`session.materialized`)."""
    return materialized(df, f"llm-{name}")


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by `stored` that no later plan reads."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def key_or_last(column: Column) -> Column:
    """A null key as the largest one, so that it joins with itself and never represents a group."""
    return F.coalesce(column.cast("long"), F.lit(NULL_KEY))


def last_as_null(column: Column) -> Column:
    return F.when(column != NULL_KEY, column)


def _is_star(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, and no node has edges both ways."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
            )
        ).alias("e")
    ).select("e.*")
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (u, v) of a task as stars: every node with the smallest one it reaches within CHUNK links."""

    def stars(parts: list[np.ndarray]) -> pd.DataFrame:
        nodes, ends = np.unique(np.concatenate(parts), return_inverse=True)
        a, b = ends.reshape(-1, 2).T
        label = np.arange(len(nodes))
        while True:
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            if (low == high).all():
                break
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label = label[label]
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return pd.DataFrame({"u": nodes[moved], "v": nodes[label[moved]]})

    held, size = [], 0
    for batch in batches:
        held.append(batch[["u", "v"]].to_numpy(dtype=np.int64).ravel())
        size += len(batch)
        if size >= CHUNK:
            yield stars(held)
            held, size = [], 0
    if held:
        yield stars(held)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: two long columns); root is the smallest reachable node.

    Each task first contracts its own links to stars, CHUNK of them at a time, as a map-side combine.
    What several tasks share is joined by alternating large-star and small-star steps: an aggregation
    and a join on the node each; a round is stored, so lost executors cost a re-read. No group is
    collected: a hub meets its neighbours only as join rows. Loops and repeated links are ignored; an
    empty table gives an empty result.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links"
    )
    while True:
        tasks = max(1, math.ceil(edges.count() / CHUNK))
        before, edges = edges, stored(edges.coalesce(tasks).mapInPandas(_contract, "u long, v long"), "stars")
        drop_stored(before)
        if tasks == 1 or _is_star(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(least, "u").select(F.explode(down).alias("e")).select("e.u", "e.v").where(F.col("u") != F.col("v"))
        before, edges = edges, stored(small.distinct(), "small-star")
        drop_stored(before)
        drop_stored(large)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
