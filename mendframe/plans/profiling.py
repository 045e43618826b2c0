"""The full profile of a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendframe.functions.columns import melt, numeric_columns, quoted
from mendframe.operators import profile
from mendframe.operators.duplicates import table_health
from mendframe.sources.writers import text_report

SHOWN_NUMBERS = 5


@dataclass(frozen=True)
class Profile:
    """Lazy frames of a table profile."""

    name: str
    basic: DataFrame
    nulls: DataFrame
    numbers: DataFrame
    categories: DataFrame
    null_pairs: DataFrame
    correlations: DataFrame
    score: DataFrame
    shown_numbers: tuple[str, ...]

    def report(self) -> DataFrame:
        return text_report(
            self.name, self.basic, self.score, self.nulls, self.numbers, self.null_pairs, self.correlations, self.shown_numbers
        )

    def metrics(self) -> DataFrame:
        """All numbers of the profile as rows (section, item, metric, value)."""
        sections = {
            "table": (self.basic, ()),
            "nulls": (self.nulls, ("column",)),
            "numbers": (self.numbers, ("column",)),
            "categories": (self.categories, ("column",)),
            "null_pairs": (self.null_pairs, ("column_a", "column_b")),
            "correlations": (self.correlations, ("column_a", "column_b")),
            "quality": (self.score, ()),
        }
        stacked = None
        for section, (frame, keys) in sections.items():
            rows = melt(
                frame,
                [
                    {
                        "section": F.lit(section),
                        "item": F.concat_ws(" ", F.lit(""), *keys) if keys else F.lit(""),
                        "metric": F.lit(c),
                        "value": quoted(c).cast("double"),
                    }
                    for c in numeric_columns(frame)
                ],
            ).withColumn("item", F.trim("item"))
            stacked = rows if stacked is None else stacked.unionByName(rows)
        return stacked


def profile_table(df: DataFrame, name: str = "dataset") -> Profile:
    """All profile frames. Each part scans the input, so store an input that is costly to compute."""
    health = table_health(df)
    return Profile(
        name,
        health.select("rows", "columns", "duplicate_extras", "duplicate_members"),
        profile.null_profile(df),
        profile.numeric_profile(df),
        profile.categorical_profile(df),
        profile.null_pairs(df),
        profile.high_correlations(df),
        profile.score_from_health(health),
        tuple(numeric_columns(df)[:SHOWN_NUMBERS]),
    )
