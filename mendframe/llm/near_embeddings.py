"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors again and again at the median of a random projection; vectors near the
median go to both sides (spill), so a near pair is seldom parted. A round fits, for every node that
is still too large, a subtree from a sample of its vectors (SAMPLE in expectation) and routes all its
vectors through it; rounds go on until every leaf is small. A node in which a fifth or more of the
sampled pairs link is not split: its links alone are of the order of its pairs, so it is compared in
blocks of bounded size. Leaves are compared completely, in double precision.

Recall does not fall with the size of the table. A split's spill is widened until it loses a pair at the
threshold no faster than the power LOSS of the share of vectors that a side takes; a tree down to leaves of
a share s then keeps the pair with s ** LOSS, and trees are added until one of them keeps it with RECALL.

Pairs are never written out. A pair that shares several leaves counts in the first of them alone, which
each side knows from the list of its leaves; a leaf gives each vector its number of new links and one
link to the smallest member of its connected part. Copies are folded before and count by their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendframe.llm.common import components, drop_stored, key_or_last, last_as_null, stored

THRESHOLD = 0.9
TREES = 6
LEAF = 1024
SAMPLE = 4096
DEPTH = 7
SPILL = 0.025
WIDER = [SPILL, 0.035, 0.05, 0.075, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4]
LOSS = 0.17
#: The estimate takes the step as independent of the place, though partners lean to the middle: 0.0865 for 0.099 of normal projections.
LEAN = 1.15
RECALL = 0.98
DENSE = 0.2
ROUNDS = 4
SLOTS = 1 << (DEPTH + 1)
MOST_TREES = 1 << 10
_STEPS = np.array([NormalDist().inv_cdf((i + 0.5) / 32) for i in range(32)])


def tree_count(vectors: int, leaf: int = LEAF) -> int:
    """Trees that keep a pair at the threshold with RECALL, as deep as `vectors` make them; TREES at least."""
    kept = min(1.0, 0.6 * leaf / max(1, vectors)) ** LOSS
    return TREES if kept >= RECALL else min(MOST_TREES, max(TREES, math.ceil(math.log(1 - RECALL) / math.log(1 - kept))))


def parted(projected: np.ndarray, low: float, high: float, reach: float) -> float:
    """Estimated share of pairs that a split parts; `projected` is sorted, a pair's parts differ by a normal step of size `reach`."""
    up, down = _STEPS[_STEPS > 0] * reach, _STEPS[_STEPS < 0] * reach
    from_left = np.searchsorted(projected, low, "left") - np.searchsorted(projected, high - up, "right")
    from_right = np.searchsorted(projected, low - down, "left") - np.searchsorted(projected, high, "right")
    return LEAN * float(np.maximum(from_left, 0).sum() + np.maximum(from_right, 0).sum()) / (len(projected) * len(_STEPS))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one in double precision; scaled first, so that no square overflows."""
    x = np.asarray(vectors, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def direction(node: int, slot: int, size: int) -> np.ndarray:
    """The random unit vector of a split; the same in every task."""
    g = np.random.default_rng([node & (2**63 - 1), slot]).standard_normal(size)
    return g / np.sqrt(g @ g)


def fit_subtree(node: int, sample: np.ndarray, count: int, threshold: float, leaf: int) -> np.ndarray:
    """Bounds (low, high) of the splits by heap slot, NaN where a slot is a leaf.

    A slot's left child takes projections up to `high`, the right one those from `low`: both take the share
    `spill` of the vectors on either side of the median, the smallest of WIDER that loses no more than LOSS.
    """
    bounds = np.full((SLOTS, 2), np.nan)
    x = unit(sample)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold) / x.shape[1])
    todo = [(1, x, float(count))]
    while todo:
        slot, part, size = todo.pop()
        if size <= leaf * 0.6 or slot >= SLOTS // 2 or len(part) < 16:
            continue
        seen = part[:256]
        near = (seen @ seen.T >= threshold).sum() - len(seen)
        if near >= DENSE * len(seen) * (len(seen) - 1):
            continue
        projected = part @ direction(node, slot, part.shape[1])
        ordered = np.sort(projected)
        for spill in WIDER:
            low, high = np.quantile(ordered, [0.5 - spill, 0.5 + spill])
            if 1 - parted(ordered, low, high, reach) >= (0.5 + spill) ** LOSS:
                break
        left, right = part[projected <= high], part[projected >= low]
        if max(len(left), len(right)) > 0.9 * len(part):
            continue
        bounds[slot] = low, high
        todo += [(2 * slot, left, size * len(left) / len(part)), (2 * slot + 1, right, size * len(right) / len(part))]
    return bounds


def route(node: int, bounds: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, positions) of the leaves that the vectors reach."""
    x = unit(vectors)
    todo = [(1, np.arange(len(x)))]
    while todo:
        slot, at = todo.pop()
        if not len(at):
            continue
        low, high = bounds[slot]
        if np.isnan(low):
            yield slot, at
            continue
        projected = x[at] @ direction(node, slot, x.shape[1])
        todo += [(2 * slot, at[projected <= high]), (2 * slot + 1, at[projected >= low])]


def _compare(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """New links of every vector of a block (i, j) of a node and its part's smallest member."""
    empty = pd.DataFrame({"cls": [], "n": [], "root": []}).astype("int64")
    frame = frame.sort_values("cls", kind="stable", ignore_index=True)
    x, side = unit(np.vstack(frame["v"].to_list())), frame["side"].to_numpy()
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    if frame["i"].iloc[0] != frame["j"].iloc[0]:
        near &= side[:, None] != side[None, :]
    linked = np.flatnonzero(near.any(axis=1))
    if not len(linked):
        return empty
    frame, near = frame.iloc[linked], near[np.ix_(linked, linked)]
    node = frame["node"].iloc[0]
    earlier = [a[a < node] for a in map(np.asarray, frame["leaves"])]
    ids = np.concatenate(earlier)
    fresh = near
    if len(ids):
        _, column = np.unique(ids, return_inverse=True)
        member = np.zeros((len(frame), column.max() + 1), dtype=np.float32)
        member[np.repeat(np.arange(len(frame)), [len(a) for a in earlier]), column] = 1
        fresh = near & (member @ member.T == 0)
    weights, labels = frame["w"].to_numpy(), np.arange(len(frame))
    while True:
        lower = np.minimum(labels, np.where(near, labels[None, :], len(labels)).min(axis=1))
        if (lower == labels).all():
            break
        labels = lower
    cls = frame["cls"].to_numpy()
    return pd.DataFrame({"cls": cls, "n": fresh @ weights, "root": cls[labels]})


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, one of them not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def leaves(vectors: DataFrame, threshold: float, trees: int, leaf: int) -> DataFrame:
    """(node, cls, w, v): every vector in the leaves it reaches in all trees."""

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fitted = [
                fit_subtree(node, np.vstack(list(sample)), count, threshold, leaf).tobytes()
                for node, count, sample in zip(batch["node"], batch["n"], batch["sample"], strict=True)
            ]
            split = [not np.isnan(np.frombuffer(b)[2]) for b in fitted]
            yield pd.DataFrame({"node": batch["node"], "bounds": fitted})[split]

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places, nodes = [], []
            for node, rows in batch.groupby("node", sort=False).indices.items():
                bounds = np.frombuffer(batch["bounds"].iloc[rows[0]]).reshape(SLOTS, 2)
                for slot, at in route(node, bounds, np.vstack(batch["v"].iloc[rows].to_list())):
                    places.append(rows[at])
                    nodes.append(np.full(len(at), node * SLOTS + slot))
            if places:
                out = batch[["cls", "w", "v"]].iloc[np.concatenate(places)]
                yield out.assign(node=np.concatenate(nodes))[["node", "cls", "w", "v"]]

    kind = vectors.schema["v"].dataType.simpleString()
    roots = F.explode(F.array(*[F.lit(t).cast("long") for t in range(trees)]))
    rows = vectors.withColumn("tree", roots).select((F.size("v").cast("long") * MOST_TREES + F.col("tree")).alias("node"), "cls", "w", "v")
    settled = None
    for _ in range(ROUNDS):
        sizes = stored(rows.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > leaf), "forest-sizes")
        if sizes.isEmpty():
            break
        chance = F.pmod(F.xxhash64("cls", "node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = rows.join(sizes, "node").where(chance < F.lit(float(SAMPLE)) / F.col("n"))
        fits = stored(
            sample.groupBy("node").agg(F.max("n").alias("n"), F.collect_list("v").alias("sample")).mapInPandas(fit, "node long, bounds binary"),
            "forest-splits",
        )
        # nodes that are small, and dense ones, are leaves
        small = rows.join(fits.select("node"), "node", "left_anti")
        settled = small if settled is None else settled.unionByName(small)
        rows = stored(rows.join(fits, "node").mapInPandas(send, f"node long, cls long, w long, v {kind}"), "forest-leaves")
    return rows if settled is None else settled.unionByName(rows)


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, trees: int | None = None, leaf: int = LEAF
) -> DataFrame:
    """One row per input row: id, n_links, component (smallest id reachable by links), kept (id = component).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do
    vectors of different lengths. Copies (equal vectors) link with each other. A null id counts as the
    largest one; a row with a null id is kept only where its component is null too. Repeated rows are
    copies of one id: they count as vectors of their own. An empty table gives an empty result. Columns
    other than the two named are not read. Every returned link has a cosine of at least `threshold`.
    The number of trees follows the number of distinct vectors unless it is given.
    """
    rows = df.select(key_or_last(F.col(id_col)).alias("id"), F.col(vector_col).alias("v"))
    good = rows.where(usable(F.col("v")))
    classes = stored(good.groupBy("v").agg(F.min("id").alias("cls0"), F.count("*").alias("w")), "vectors")
    # a repeated id can stand in several classes: a class is then named by a number of its own
    classes = stored(classes.select(F.monotonically_increasing_id().alias("cls"), "cls0", "w", "v"), "vector-classes")
    trees = tree_count(classes.count(), leaf) if trees is None else trees
    found = stored(leaves(classes.select("cls", "w", "v"), threshold, trees, leaf), "leaves")
    signature = found.groupBy("cls").agg(F.array_sort(F.collect_set("node")).alias("leaves"))
    blocks = found.groupBy("node").agg(F.ceil(F.count("*") / F.lit(float(leaf))).cast("long").alias("blocks"))
    placed = found.join(blocks, "node").join(signature, "cls").withColumn("side", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = pairs.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")})

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return _compare(frame, threshold)

    links = stored(
        pairs.select("node", "i", "j", "cls", "w", "v", "leaves", "side").groupBy("node", "i", "j").applyInPandas(compare, "cls long, n long, root long"),
        "vector-links",
    )
    counts = links.groupBy("cls").agg(F.sum("n").alias("n"))
    roots = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    labelled = (
        classes.join(counts, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("v", "cls0", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    )
    labelled = stored(labelled, "vector-labels")
    smallest = labelled.groupBy("root").agg(F.min("cls0").alias("component"))
    by_vector = labelled.join(smallest, "root").select("v", "n_links", "component")
    joined = good.join(by_vector, "v").select("id", "n_links", "component")
    alone = rows.where(~usable(F.col("v"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    drop_stored(found)
    return joined.unionByName(alone).select(
        last_as_null(F.col("id")).alias("id"),
        "n_links",
        last_as_null(F.col("component")).alias("component"),
        (F.col("id") == F.col("component")).alias("kept"),
    )
