"""Writers: CSV, parquet, GeoJSON lines, JSON metrics and the text report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendframe.functions.columns import quoted


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header: padding stays, a blank is written as "" and NULL as nothing, quotes are doubled.

    Line breaks stay inside their quotes; `read_csv` reads them back.
    """
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": "", "emptyValue": '""'}
    df.write.mode("overwrite").options(**options).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def feature_lines(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One GeoJSON feature per row as text; geometry text is embedded, on the same line."""
    shape = F.translate(quoted(geometry), "\r\n", "  ")
    properties = F.to_json(F.struct(*[quoted(c) for c in df.columns if c != geometry]))
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","properties":'),
            properties,
            F.lit(',"geometry":'),
            F.coalesce(shape, F.lit("null")),
            F.lit("}"),
        ).alias("value")
    )


def write_geojson_lines(df: DataFrame, path: str, geometry: str = "geometry") -> None:
    feature_lines(df, geometry).write.mode("overwrite").text(path)


def write_metrics(metrics: DataFrame, path: str, run: str | None = None) -> None:
    """Metric rows as JSON lines with the run they belong to; appends, so runs build a history."""
    stamp = F.lit(run) if run else F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
    metrics.withColumn("run", stamp).write.mode("append").json(path)


def _whole(c: str) -> Column:
    return F.format_number(F.col(c), 0)


def text_report(
    name: str,
    basic: DataFrame,
    score: DataFrame,
    nulls: DataFrame,
    numbers: DataFrame,
    pairs: DataFrame,
    correlations: DataFrame,
    shown_numbers: Sequence[str],
) -> DataFrame:
    """Report lines (section, position, line) from profile frames, which are small already.

    Of the number columns those named in `shown_numbers` have a line.
    """
    sections = [
        basic.select(
            F.lit(1).alias("section"),
            F.lit("").alias("position"),
            F.concat_ws(
                "\n",
                F.lit(f"DATA PROFILE: {name}"),
                F.concat(F.lit("  rows: "), _whole("rows")),
                F.concat(F.lit("  columns: "), F.col("columns").cast("string")),
                F.concat(F.lit("  duplicates: "), _whole("duplicate_extras")),
            ).alias("line"),
        ),
        score.select(
            F.lit(2),
            F.lit(""),
            F.format_string(
                "QUALITY\n  score: %.2f/100 (%s)\n  completeness: %.2f%%\n  consistency: %.2f%%",
                "score", "state", "completeness", "consistency",
            ),
        ),
        nulls.select(
            F.lit(3),
            F.format_string("%020d %s", F.lit(10**18) - F.col("nulls"), "column"),
            F.format_string(
                "NULLS %s: %s (%.2f%%), reliability %.2f%%", "column", _whole("nulls"), "null_percent", "reliability"
            ),
        ),
        numbers.filter(F.col("column").isin(list(shown_numbers))).select(
            F.lit(4),
            "column",
            F.format_string(
                "NUMBERS %s: mean %s, median %s, zeros %s (%.2f%%), outliers %s (%.2f%%), reliability %.2f%%",
                "column", F.format_number("mean", 2), F.format_number("median", 2), _whole("zeros"),
                "zeros_percent", _whole("outliers"), "outliers_percent", "reliability",
            ),
        ),
        pairs.select(
            F.lit(5),
            F.concat_ws(" ", "column_a", "column_b"),
            F.format_string("NULL TOGETHER %s, %s: %s (%.2f%%)", "column_a", "column_b", _whole("both_null"), "percent"),
        ),
        correlations.select(
            F.lit(6),
            F.concat_ws(" ", "column_a", "column_b"),
            F.format_string("CORRELATED %s, %s: %.3f", "column_a", "column_b", F.bround("correlation", 3)),
        ),
    ]
    lines = sections[0]
    for section in sections[1:]:
        lines = lines.union(section)
    return lines.orderBy("section", "position")


def write_text_report(lines: DataFrame, path: str) -> None:
    """The report in one file: a few lines per column."""
    lines.select("line").coalesce(1).write.mode("overwrite").text(path)
