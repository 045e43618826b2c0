"""Corpus pipeline: language, near-duplicates, personal data, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes as parquet and
reads again as the next stage's input. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mendframe.llm import bpe, langid, mixing, pii, simhash
from mendframe.llm.common import ship
from mendframe.session import materialized

VOCABULARY = "word_bpe_49k.json"
MIX = mixing.Target(entropy=0.9)

#: Trained weights, hash functions and a tokenizer stand in every stage: see tests/llm for brute-force versions.
ORACLE_SQL = None


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Texts go to Python in batches of so many rows and bytes, whichever comes first: a worker and its executor hold a
#: few MB for each evaluation instead of 10,000 texts.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def stage(fn):
    """A stage whose package the executors have, and which other columns than those of documents pass under names of their own."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        inside = {f"passing_{i}_": c for i, c in enumerate(docs.columns) if c not in COLUMNS}
        names = {c: n for n, c in inside.items()}
        out = fn(spark, docs.toDF(*[names.get(c, c) for c in docs.columns]), sf_dir)
        return out.toDF(*[inside.get(c, c) for c in out.columns])

    return run_stage


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is identified; text, declared language and source speak together."""
    model = langid.fit_text_model(docs)
    return langid.keep_identified(docs, model, text_col="text", declared_col="lang", host_col="source")


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates, the one with the smallest id; ids may repeat or be missing."""
    return simhash.keep_one_row(docs)


@stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and disclosing terms in the texts; n_chars follows the new text."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that sources reach the target entropy; every document stays at least once."""
    return mixing.realise(mixing.mix(docs, MIX)).select(*docs.columns)


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row and a digest of the text that they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode_decode(docs.select("doc_id", "source", "text"), path).select(
        "doc_id",
        "source",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = materialized(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
