"""Token counts of fields and sections by offset-mapped attribution.

A document is encoded once, as a whole, so tokens are those that a model would see. Each token has a
character span; the spans are joined to the sections' intervals by binary search, and a token that
crosses a boundary goes by an explicit rule:

- "first": to the section of its first character,
- "most": to the section with most of its characters, of equal ones the first,
- "split": to all sections it touches, in shares of its characters.

A byte-level token may hold part of a character; its span holds every character it touches. Counts
of all sections add up to the tokens of the document under every rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("first", "most", "split")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class SpanEncoder:
    """Encodes texts with a rank file and gives the character spans of the tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("token_counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(first character, end) of every token; the special tokens' strings are ordinary text."""
        ids = np.asarray(self.encoding.encode_ordinary(text), dtype=np.int64)
        ends = np.cumsum(self.sizes[ids])
        starts = ends - self.sizes[ids]
        if len(ids) and int(ends[-1]) != len(text):
            # the number of the character that each byte belongs to
            raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
            character = np.cumsum((raw & 0xC0) != 0x80) - 1
            starts, ends = character[starts], character[ends - 1] + 1
        return starts, ends


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "first") -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that cross a boundary).

    Section i reaches from bounds[i] to bounds[i + 1]; sections may be empty and then get no token.
    """
    sections = len(bounds) - 1
    if not len(starts):
        return np.zeros(sections), 0
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = np.flatnonzero(first != last)
    counts = np.bincount(first, minlength=sections).astype(np.float64)
    if rule != "first":
        for t in crossing.tolist():
            parts = np.arange(first[t], last[t] + 1)
            shared = np.minimum(ends[t], bounds[parts + 1]) - np.maximum(starts[t], bounds[parts])
            counts[first[t]] -= 1
            if rule == "most":
                counts[parts[np.argmax(shared)]] += 1
            else:
                counts[parts] += shared / shared.sum()
    return counts, len(crossing)


def line_bounds(text: str) -> np.ndarray:
    """Lines as sections, each with its line break; an empty text is one empty line."""
    bounds, at = [0], text.find("\n")
    while at >= 0:
        bounds.append(at + 1)
        at = text.find("\n", at + 1)
    if bounds[-1] != len(text) or len(bounds) == 1:
        bounds.append(len(text))
    return np.asarray(bounds, dtype=np.int64)


_SECTIONS = "array<struct<section:int,start:long,end:long,n_tokens:double>>"


def _counted(df: DataFrame, columns: list[str], whole, path: str, pattern: str, rule: str, names: list[str] | None) -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    @F.pandas_udf(f"struct<n_tokens:long,n_crossing:long,sections:{_SECTIONS}>")
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = SpanEncoder(ranks.value, pattern)
        for batch in batches:
            rows = []
            for values in batch.itertuples(index=False):
                text, bounds = whole(*values)
                starts, ends = encoder.spans(text)
                counts, crossing = attribute(starts, ends, bounds, rule)
                parts = zip(range(len(counts)), bounds[:-1].tolist(), bounds[1:].tolist(), counts.tolist(), strict=True)
                rows.append((len(starts), crossing, [dict(zip(("section", "start", "end", "n_tokens"), p, strict=True)) for p in parts]))
            yield pd.DataFrame(rows, columns=["n_tokens", "n_crossing", "sections"])

    fields = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"f{i}") for i, c in enumerate(columns)])
    return df.withColumn("_counts", counted(fields))


def section_counts(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", rule: str = "first") -> DataFrame:
    """One row per line of every text: id, section (from 0), start, end (code points), n_tokens, total_tokens, n_crossing.

    total_tokens and n_crossing (tokens over a line's end) are the document's. A null text counts as
    empty and has one empty line without tokens. Null and repeated ids are rows like others; an empty
    table gives an empty result; other columns are not read. n_tokens is a double, whole but under "split".
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = _counted(rows, ["text"], lambda text: (text, line_bounds(text)), path, pattern, rule, None)
    return counted.select(
        "id", F.col("_counts.n_tokens").alias("total_tokens"), F.col("_counts.n_crossing").alias("n_crossing"), F.inline("_counts.sections")
    )


def field_counts(df: DataFrame, path: str, pattern: str, id_col: str, fields: list[str], separator: str = "\n", rule: str = "first") -> DataFrame:
    """One row per input row and field: id, field, n_tokens, total_tokens, n_crossing.

    The document is the fields in order, joined by `separator`, which belongs to the field before it.
    Null fields count as empty. Otherwise as `section_counts`.
    """
    names = [f"c{i}" for i in range(len(fields))]
    rows = df.select(F.col(id_col).alias("id"), *[F.col(f).alias(n) for f, n in zip(fields, names, strict=True)])

    def whole(*values: str) -> tuple[str, np.ndarray]:
        parts = [v + separator for v in values[:-1]] + [values[-1]]
        return "".join(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    counted = _counted(rows, names, whole, path, pattern, rule, fields)
    flat = counted.select("id", F.col("_counts.n_tokens").alias("total_tokens"), F.col("_counts.n_crossing").alias("n_crossing"), F.inline("_counts.sections"))
    by_number = F.array(*[F.lit(f) for f in fields])
    return flat.select("id", by_number[F.col("section")].alias("field"), "n_tokens", "total_tokens", "n_crossing")
