"""Language identification by Bayesian evidence fusion.

log P(language | text, markup, suffix, host) is, up to a constant, the sum of
- the text's log likelihood: hashed letter trigrams per language, smoothed, plus a background model
  (label "und") under which every trigram is equally likely; tempered by `TEMPER`, as neighbouring
  trigrams are not independent,
- log P(declared markup language | language) and log P(address suffix | language), estimated by
  grouped aggregation of the text posteriors, each smoothed towards the value's overall share,
- the host's log prior: posterior counts by host, smoothed towards those of the suffix, and these
  towards the overall ones.

Missing evidence (null or empty) adds nothing. The trigram tables have a fixed number of cells
(BUCKETS x languages) and are fitted on a sample of each label's rows (SAMPLE distinct texts, by hash
of the text; all rows of a label with fewer), so no language depends on the size of the others; all
other counts cover every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.llm.common import stored

BUCKETS = 1 << 16
SAMPLE = 20_000
TEMPER = 0.1
ADD = 0.5
HOST_WEIGHT = 20.0
SUFFIX_WEIGHT = 50.0
EVIDENCE_WEIGHT = 10.0
UNKNOWN = "und"
UNKNOWN_PRIOR = 1e-3
PART = 1 << 20


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Cells of the letter trigrams of a text, a part at a time; runs of other characters count as one blank."""
    text = (text or "").lower()
    for at in range(0, len(text), PART):
        points = np.frombuffer(text[at : at + PART + 2].encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
        letter = (points >= 97) & (points <= 122) | (points >= 0xC0) & (points != 0xD7) & (points != 0xF7) & ((points < 0x2000) | (points > 0x2BFF))
        points = np.where(letter, points, 32)
        points = points[letter | np.append(True, letter[:-1])]
        points = np.concatenate([[32], points, [32]]).astype(np.uint64)
        if letter.any():
            mixed = (points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA77) + points[2:] * np.uint64(0xC2B2AE3D)) * np.uint64(0x9E3779B97F4A7C15)
            yield (mixed >> np.uint64(48)).astype(np.int64) % BUCKETS


@dataclass(frozen=True)
class TextModel:
    """Languages in order, the background last, and the log2 weights of every trigram cell."""

    languages: list[str]
    weights: np.ndarray

    def scores(self, text: str | None) -> np.ndarray:
        """Tempered log likelihoods; zeros where there is no letter."""
        total = np.zeros(len(self.languages))
        for cells in trigrams(text):
            total += self.weights[cells].sum(axis=0)
        return total * TEMPER


def fit_text_model(labelled: DataFrame, text_col: str = "text", label_col: str = "lang") -> TextModel:
    """Trigram weights from a sample of each label's rows: those of SAMPLE distinct texts in expectation, by hash of the text.

    A label with no more distinct texts gives all its rows. Every label is a language of the model, which
    holds half a MB for each; null and empty labels are left out. Smoothing adds at most half of what a label's
    rows count, so that a handful of rows is not levelled out. With no labelled row the model knows the background alone.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.lower(F.trim(F.col(label_col))).alias("label")).where("label <> '' AND text IS NOT NULL")
    digest = F.xxhash64("text")
    labels = rows.groupBy("label").agg(F.approx_count_distinct(digest).alias("texts")).collect()
    names = sorted(r["label"] for r in labels)
    if names:
        places = {name: at for at, name in enumerate(names)}
        bounds = [(r["label"], int(min(1.0, SAMPLE / max(1, r["texts"])) * (1 << 30))) for r in labels]
        partial = [(label, bound) for label, bound in bounds if bound < 1 << 30]
        bound = F.lit(1 << 30)
        if partial:
            bound = F.coalesce(F.create_map(*[F.lit(x) for pair in partial for x in pair])[F.col("label")], bound)
        picked = rows.where(F.pmod(digest, F.lit(1 << 30)) < bound)

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cells: dict[int, np.ndarray] = {}
            for batch in batches:
                for text, label in zip(batch["text"], batch["label"], strict=True):
                    for part in trigrams(text):
                        held = cells.setdefault(places[label], np.zeros(BUCKETS, dtype=np.int64))
                        held += np.bincount(part, minlength=BUCKETS)
            for at, held in cells.items():
                cell = held.nonzero()[0]
                yield pd.DataFrame({"label": np.full(len(cell), at, dtype=np.int64), "cell": cell, "n": held[cell]})

        found = picked.mapInPandas(count, "label long, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).toPandas()
    cells = np.full((len(names) + 1, BUCKETS), 0.0)
    if names:
        cells[found["label"], found["cell"]] = found["n"]
    seen = max(1, int((cells.sum(axis=0) > 0).sum()))
    counts = cells.sum(axis=1, keepdims=True)
    add = ADD * np.minimum(1.0, np.maximum(counts, 1.0) / BUCKETS)
    weights = np.log((cells + add) / (counts + add * BUCKETS))
    weights[-1] = -math.log(max(seen, BUCKETS // 4))
    return TextModel([*names, UNKNOWN], np.ascontiguousarray(weights.T))


def _normal(name: str | None) -> Column:
    """A declared language as its first subtag in lower case; null where the column is missing or empty."""
    if name is None:
        return F.lit(None).cast("string")
    value = F.regexp_extract(F.lower(F.trim(F.col(name).cast("string"))), "^([a-z]+)", 1)
    return F.when(value != "", value)


def _text(name: str | None) -> Column:
    if name is None:
        return F.lit(None).cast("string")
    value = F.lower(F.trim(F.col(name).cast("string")))
    return F.when(value != "", value)


def _likelihoods(model: TextModel, df: DataFrame):
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.scores(t).tolist() for t in texts], dtype=object)

    return scores


def _posterior(scores: Column) -> Column:
    """Normalised exponentials of an array column."""
    top = F.array_max(scores)
    powers = F.transform(scores, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _table(rows: DataFrame, by: str, names: int) -> DataFrame:
    """Summed posteriors by a value: (by, n array)."""
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(names)]
    return rows.where(F.col(by).isNotNull()).groupBy(by).agg(*sums).select(by, F.array(*[f"s{i}" for i in range(names)]).alias("n"))


def identify(
    df: DataFrame,
    model: TextModel,
    text_col: str = "text",
    declared_col: str | None = None,
    suffix_col: str | None = None,
    host_col: str | None = None,
) -> DataFrame:
    """`df` with language, language_p (its posterior) and language_text (the best by text alone, null without letters).

    Rows without letters and without other evidence get "und" with its prior share at best. Null or
    empty evidence adds nothing; repeated rows count as often as they stand in the table and get equal
    results; ties go to the first language by name. An empty table stays empty. Columns of the result's
    names in `df` are replaced.

    The first pass stores the posteriors of the text without the text. Its sums by host, suffix and
    declared language are small tables that join the rows of a second pass by value.
    """
    k = len(model.languages)
    out_names = [c for c in df.columns if c not in ("language", "language_p", "language_text")]
    named = {c: f"c{i}" for i, c in enumerate(df.columns)}
    df, columns = df.toDF(*named.values()), [named[c] for c in out_names]
    text_col, declared_col, suffix_col, host_col = (named[c] if c else None for c in (text_col, declared_col, suffix_col, host_col))
    scores = _likelihoods(model, df)
    evidence = [_normal(declared_col).alias("_declared"), _text(suffix_col).alias("_suffix"), _text(host_col).alias("_host")]
    first = stored(
        df.select(scores(F.col(text_col)).alias("x"), *evidence), "language-scores"
    ).withColumn("p", _posterior(F.col("x")))
    totals = first.agg(F.count("*").alias("rows"), *[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)]).first()
    rows = max(1, totals["rows"])
    overall = [((totals[f"s{i}"] or 0.0) + 1.0) / (rows + k) for i in range(k)]
    overall[-1] = min(overall[-1], UNKNOWN_PRIOR)
    everywhere = F.array(*[F.lit(x / sum(overall)) for x in overall])

    def smoothed(towards: Column, weight: float) -> Column:
        total = F.aggregate("n", F.lit(0.0), lambda a, x: a + x)
        return F.transform(F.zip_with("n", towards, lambda n, t: n + weight * t), lambda x: x / (total + weight))

    def given(by: str) -> DataFrame:
        """log P(value | language), smoothed towards the value's overall share."""
        share = F.aggregate("n", F.lit(0.0), lambda a, x: a + x) / rows
        per = F.array(*[F.lit(totals[f"s{i}"] or 0.0) for i in range(k)])
        logs = F.transform(F.zip_with("n", per, lambda n, t: (n + EVIDENCE_WEIGHT * share) / (t + EVIDENCE_WEIGHT)), lambda x: F.log(x))
        return _table(first, by, k).select(by, logs.alias(f"log{by}"))

    # tables by value are stored, so that the join knows their size: small ones go to the rows, and the texts stay in place
    tables = {}
    if declared_col:
        tables["_declared"] = stored(given("_declared"), "language-declared")
    if suffix_col:
        tables["_suffix"] = stored(given("_suffix"), "language-suffixes")
    if host_col:
        hosts = _table(first, "_host", k)
        above = everywhere
        if suffix_col:
            # a host's parent is the suffix it is met with most often; without one, the whole table
            priors = _table(first, "_suffix", k).select("_suffix", smoothed(everywhere, SUFFIX_WEIGHT).alias("prior"))
            parent = first.where("_host IS NOT NULL").groupBy("_host", "_suffix").agg(F.count("*").alias("c"))
            parent = parent.groupBy("_host").agg(F.max_by("_suffix", F.struct("c", "_suffix")).alias("_suffix"))
            hosts = hosts.join(parent, "_host").join(priors, "_suffix", "left")
            above = F.coalesce("prior", everywhere)
        priors = smoothed(above, HOST_WEIGHT)
        tables["_host"] = stored(hosts.select("_host", F.transform(priors, lambda x: F.log(x)).alias("log_host")), "language-hosts")

    out = df.select(*columns, *evidence, scores(F.col(text_col)).alias("_text"))
    for by, values in tables.items():
        out = out.join(values, by, "left")
    zero = F.array(*[F.lit(0.0)] * k)
    fused = F.col("_text")
    overall_log = F.transform(everywhere, lambda x: F.log(x))
    parts = [F.coalesce(f"log{by}", zero) for by in tables if by != "_host"]
    for part in [*parts, F.coalesce("log_host", overall_log) if host_col else overall_log]:
        fused = F.zip_with(fused, part, lambda a, b: a + b)
    names = F.array(*[F.lit(n) for n in model.languages])

    def best(values: Column) -> Column:
        return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))

    silent = F.forall("_text", lambda x: x == 0.0)
    return (
        out.withColumn("_p", _posterior(fused))
        .select(
            *columns,
            best(F.col("_p")).alias("language"),
            F.array_max("_p").alias("language_p"),
            F.when(~silent, best(F.col("_text"))).alias("language_text"),
        )
        .toDF(*out_names, "language", "language_p", "language_text")
    )


def keep_identified(df: DataFrame, model: TextModel, least: float = 0.5, **evidence: str) -> DataFrame:
    """Rows whose language is known with at least `least` posterior and whose text holds letters; columns unchanged."""
    found = identify(df, model, **evidence)
    kept = found.where((F.col("language") != UNKNOWN) & (F.col("language_p") >= least) & F.col("language_text").isNotNull())
    return kept.select(*df.columns)
