"""Sample property rows: seeded by keys, so the same rows come out under any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendframe import fixed_values as fixed
from mendframe.functions.columns import quoted
from mendframe.functions.hashing import hash_number, hash_uniform, weighted_choice


def sample_properties(
    groups: DataFrame,
    name: str,
    rows: tuple[int, int] = fixed.SAMPLE_GROUP_ROWS,
    types: list[str] = fixed.SAMPLE_TYPES,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Random rows for each group: between the two row counts (upper bound excluded)."""
    low, high = rows
    group = quoted(name)
    count = F.lit(low) + hash_number(group, f"{seed}rows") % F.lit(high - low)
    numbered = groups.select(group.alias("barrio_nombre"), F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("i"))
    key = F.concat(
        F.lit("PRED_"), F.replace("barrio_nombre", F.lit(" "), F.lit("")), F.lit("_"), F.lpad(F.col("i").cast("string"), 5, "0")
    )

    def uniform(part: str, low: float, high: float):
        return F.lit(low) + hash_uniform(F.col("id_predio"), f"{seed}{part}") * F.lit(high - low)

    first_score, last_score = fixed.SAMPLE_SCORE_RANGE
    weights = fixed.SAMPLE_STRATUM_WEIGHTS
    type_weights = {t: 1 / len(types) for t in types}
    return numbered.select(key.alias("id_predio"), "barrio_nombre").select(
        "id_predio",
        "barrio_nombre",
        weighted_choice(hash_uniform(F.col("id_predio"), f"{seed}stratum"), weights).alias("estrato"),
        uniform("value", *fixed.SAMPLE_VALUE_RANGE).alias("avaluo_total"),
        uniform("area", *fixed.SAMPLE_AREA_RANGE).alias("area_construida"),
        (F.lit(first_score) + hash_number(F.col("id_predio"), f"{seed}score") % (last_score - first_score))
        .cast("int")
        .alias("puntaje"),
        weighted_choice(hash_uniform(F.col("id_predio"), f"{seed}type"), type_weights).alias("tipo_construccion"),
    )
