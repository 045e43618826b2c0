"""Key-derived pseudo-random values: the same for any partitioning and in any SQL engine with md5."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 8
HASH_SPACE = 16**HEX_DIGITS


def key_digest(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def hash_number(key: Column, seed: int | str) -> Column:
    """Whole number in [0, 2^32) from the first eight hex digits of the digest."""
    return F.conv(F.substring(key_digest(key, seed), 1, HEX_DIGITS), 16, 10).cast("bigint")


def hash_uniform(key: Column, seed: int | str) -> Column:
    """Uniform value in [0, 1)."""
    return hash_number(key, seed) / F.lit(float(HASH_SPACE))


def hash_normal(key: Column, seed: int | str, scale: float) -> Column:
    """Normal value with mean 0 (Box-Muller over two uniforms)."""
    u1 = (hash_number(key, f"{seed}a") + F.lit(1)) / F.lit(float(HASH_SPACE))
    u2 = hash_uniform(key, f"{seed}b")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2) * F.lit(scale)


def fold_number(key: Column, folds: int, seed: int | str) -> Column:
    return (hash_number(key, seed) % F.lit(folds)).cast("int")


def weighted_choice(uniform: Column, weights: dict[object, float]) -> Column:
    """Pick a value by cumulative weight; the last value takes what rounding leaves over."""
    items = list(weights.items())
    chosen, total = None, 0.0
    for value, weight in items[:-1]:
        total += weight
        bound = F.lit(round(total, 12))
        chosen = F.when(uniform < bound, F.lit(value)) if chosen is None else chosen.when(uniform < bound, F.lit(value))
    last = F.lit(items[-1][0])
    return last if chosen is None else chosen.otherwise(last)
