"""Schema helpers: quoting, column selection by type or suffix, one-row to long reshaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column reference that is safe for names with dots, brackets or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def columns_with_suffix(df: DataFrame, suffixes: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c.endswith(tuple(suffixes))]


def without_suffix(name: str, suffixes: Sequence[str]) -> str:
    for suffix in suffixes:
        if name.endswith(suffix):
            return name[: -len(suffix)]
    return name


def melt(df: DataFrame, records: Iterable[Mapping[str, Column]], keep: Sequence[str] = ()) -> DataFrame:
    """Turn each input row into one output row per record (an inline array of structs)."""
    structs = [F.struct(*[value.alias(name) for name, value in record.items()]) for record in records]
    return df.select(*[quoted(c) for c in keep], F.inline(F.array(*structs)))


def value_rows(df: DataFrame, columns: Sequence[str], cast: str | None = None) -> DataFrame:
    """Long form (column, value) of the given columns, one scan for all of them."""
    values = df.select(*[(quoted(c).cast(cast) if cast else quoted(c)).alias(c) for c in columns])
    return values.unpivot([], [quoted(c) for c in columns], "column", "value")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in float and double columns; NULL is the only missing marker afterwards."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(quoted(c)), quoted(c)).alias(c) if c in floating else quoted(c)
            for c in df.columns
        ]
    )


def groupable(df: DataFrame) -> DataFrame:
    """Render MAP columns as JSON text so that whole rows can be grouped."""
    maps = {f.name for f in df.schema if isinstance(f.dataType, T.MapType)}
    if not maps:
        return df
    return df.select(*[F.to_json(quoted(c)).alias(c) if c in maps else quoted(c) for c in df.columns])
