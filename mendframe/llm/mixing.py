"""Temperature mixing of sources to target weights.

With p(s) the share of all tokens that source s holds, the weights are p(s)^a / sum p^a. The exponent
a in [0, 1] is bisected (a round tries STEPS exponents in one aggregate over the source table) to the
largest one that reaches a target entropy, given as a share of log(sources), or that keeps the
repetition of the most repeated source within a limit. Beyond reach, the nearer end is taken.

The weights are realised as block permutations: an epoch of a source is its documents in hash order.
Whole epochs come first; of the last, partial one the documents at the beginning of the permutation
are taken while they fit the source's token budget. Tokens are summed by block (leading hash bits),
and only the block that the budget ends in is looked at document by document, so a hot source never
stands in one task, and the outcome is one cut hash per source that any row can be held against.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendframe.llm.common import stored

STEPS = 16
ROUNDS = 10
BLOCK_BITS = 12
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """entropy: share of log(number of sources), 0 to 1; or repetition: epochs of the most repeated source."""

    entropy: float | None = None
    repetition: float | None = None


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def exponent(sources: DataFrame, target: Target, budget: float | None) -> float:
    """The bisected exponent for a table of (tokens > 0); budget in tokens, None: see `mix`."""
    total = sources.agg(F.sum("tokens").cast("double").alias("t"), F.count("*").alias("n")).first()
    if not total["n"] or total["n"] == 1:
        return 1.0
    log_p = F.log(F.col("tokens") / F.lit(total["t"]))
    low, high, tried = 0.0, 1.0, None

    def meets(a: float, row) -> bool:
        z, weighted = row[f"z{a}"], row[f"x{a}"]
        if target.entropy is not None:
            return math.log(z) - a * weighted / z >= target.entropy * math.log(total["n"]) - 1e-12
        # repetition of s is p^(a-1) / z * budget / total; without a budget the least one is set to 1
        most, least = row[f"most{a}"], row[f"least{a}"]
        return (most / z * budget / total["t"] if budget else most / least) <= target.repetition + 1e-12

    for _ in range(ROUNDS):
        tried = [low + (high - low) * i / STEPS for i in range(STEPS + 1)]
        columns = []
        for i, a in enumerate(tried):
            power = F.exp(log_p * a)
            columns += [F.sum(power).alias(f"z{i}"), F.sum(power * log_p).alias(f"x{i}")]
            columns += [F.max(F.exp(log_p * (a - 1))).alias(f"most{i}"), F.min(F.exp(log_p * (a - 1))).alias(f"least{i}")]
        row = sources.agg(*columns).first().asDict()
        row = {f"{k}{a}": row[f"{k}{i}"] for i, a in enumerate(tried) for k in ("z", "x", "most", "least")}
        good = [meets(a, row) for a in tried]
        if target.entropy is not None:
            # entropy falls as the exponent grows: the largest exponent that still reaches it
            last = max((i for i, g in enumerate(good) if g), default=0)
            low, high = tried[last], tried[min(last + 1, STEPS)]
            result = low
        else:
            # repetition falls as the exponent grows: the smallest exponent that keeps the limit
            first = min((i for i, g in enumerate(good) if g), default=STEPS)
            low, high = tried[max(first - 1, 0)], tried[first]
            result = high
        if low == high:
            break
    return result


def _source_key(source: str) -> Column:
    """Null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def mix(
    df: DataFrame,
    target: Target,
    budget: float | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: int = 42,
) -> DataFrame:
    """`df` with n_tokens (words), weight (of the row's source) and copies (times the row is taken, from 0).

    `budget` is the number of tokens to give out; None: the smallest one that takes every document at
    least once. A null source is a source of its own. Sources without a token have weight 0 and are
    taken once. Rows with equal id and text stand next to each other in the permutation and are taken
    together or not at all in the partial epoch; it never exceeds the source's budget. Null texts
    count no token. Columns of the result's names are replaced; an empty table stays empty.
    """
    out_names = [c for c in df.columns if c not in ("n_tokens", "weight", "copies")]
    named = {c: f"c{i}" for i, c in enumerate(df.columns)}
    plain = df.toDF(*named.values())
    at, text = F.col(named[id_col]).cast("string"), F.col(named[text_col])
    marked = plain.withColumns(
        {"_source": _source_key(named[source_col]), "_tokens": word_count(text), "_hash": F.xxhash64(F.lit(seed), at, text)}
    )
    block = F.shiftright("_hash", 64 - BLOCK_BITS)
    # one scan: tokens by source and block; sources come from the blocks
    blocks = stored(
        marked.groupBy("_source", block.alias("_block")).agg(F.sum("_tokens").alias("tokens")), "mix-blocks"
    )
    sources = stored(blocks.groupBy("_source").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    filled = sources.where("tokens > 0")
    a = exponent(filled, target, budget)
    total = filled.agg(F.sum("tokens").cast("double")).first()[0] or 1.0
    power = F.exp(F.log(F.col("tokens") / F.lit(total)) * F.lit(a))
    sums = filled.agg(F.sum(power), F.max(F.col("tokens") / power)).first()
    z = sums[0] or 1.0
    if budget is None:
        budget = (sums[1] or 0.0) * z
    weight = F.when(F.col("tokens") > 0, power / F.lit(z)).otherwise(F.lit(0.0))
    epochs = F.when(F.col("tokens") > 0, weight * F.lit(float(budget)) / F.col("tokens")).otherwise(F.lit(1.0))
    quotas = sources.select(
        "_source",
        weight.alias("weight"),
        F.floor(epochs + 1e-9).alias("whole"),
        F.floor(F.greatest(F.lit(0.0), epochs - F.floor(epochs + 1e-9)) * F.col("tokens") + 1e-6).alias("rest"),
    )
    running = F.sum("tokens").over(Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0))
    ends = (
        blocks.withColumn("until", running).join(quotas, "_source").where(F.col("until") > F.col("rest"))
        .groupBy("_source")
        .agg(F.min_by(F.struct("_block", (F.col("until") - F.col("tokens")).alias("before"), "rest"), "_block").alias("e"))
        .select("_source", "e.*")
    )
    inside = marked.select("_source", block.alias("_block"), "_hash", "_tokens").join(ends, ["_source", "_block"])
    # documents of a hash value go together: the frame takes in peers
    peers = Window.partitionBy("_source").orderBy("_hash").rangeBetween(Window.unboundedPreceding, 0)
    cuts = (
        inside.withColumn("until", F.col("before") + F.sum("_tokens").over(peers))
        .groupBy("_source")
        .agg(
            F.max(F.when(F.col("until") <= F.col("rest"), F.col("_hash"))).alias("last"),
            F.min(F.shiftleft(F.col("_block"), 64 - BLOCK_BITS)).alias("first"),
        )
        .select("_source", F.coalesce(F.col("last") + 1, F.col("first")).alias("cut"))
    )
    decided = stored(quotas.join(cuts, "_source", "left").select("_source", "weight", "whole", "cut"), "mix-cuts")
    extra = F.when(F.col("_hash") < F.col("cut"), F.lit(1)).otherwise(F.lit(0))
    return (
        marked.join(decided, "_source")
        .select(*[named[c] for c in out_names], "_tokens", "weight", (F.col("whole") + extra).cast("long").alias("copies"))
        .toDF(*out_names, "n_tokens", "weight", "copies")
    )


def realise(mixed: DataFrame, copies_col: str = "copies") -> DataFrame:
    """One row per copy taken, with its epoch from 0 as column `epoch`; rows with no copy go."""
    return mixed.where(F.col(copies_col) > 0).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies_col) - 1))
    )
