"""Ordered-threshold classifications as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mendframe import fixed_values as fixed


def quality_state(score: Column) -> Column:
    """State of an unrounded quality score."""
    states = [F.when(score >= low, F.lit(state)) for low, state in fixed.QUALITY_BANDS]
    return F.when(score.isNotNull(), F.coalesce(*states, F.lit(fixed.QUALITY_LOWEST)))


def completeness_colour(completeness: Column) -> Column:
    colours = [F.when(completeness < high, F.lit(colour)) for high, colour in fixed.COMPLETENESS_COLOURS]
    return F.when(completeness.isNotNull(), F.coalesce(*colours, F.lit(fixed.COMPLETENESS_BEST_COLOUR)))


def _prestige(pick, stratum: Column, value: Column | None) -> Column:
    branches = []
    for position, row in enumerate(fixed.PRESTIGE):
        _, _, level, least_value = row
        if level is None:
            branches.append(F.lit(pick(row)))
            continue
        hit = stratum >= level if position == 0 else stratum == level
        if value is not None:
            hit = hit | (value >= least_value)
        branches.append(F.when(hit, F.lit(pick(row))))
    return F.coalesce(*branches)


def prestige_label(stratum: Column, value: Column | None = None) -> Column:
    """Class by stratum, or by stratum and average value when a value is given."""
    return _prestige(lambda row: row[0], stratum, value)


def prestige_score(stratum: Column, value: Column | None = None) -> Column:
    return _prestige(lambda row: row[1], stratum, value)
