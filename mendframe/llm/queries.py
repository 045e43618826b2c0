"""Queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mendframe.llm import bpe, conversations, decontaminate, fingerprint, langid, licences, mixing, near_embeddings, ngram_lm, periodic, pii, simhash, token_counts
from mendframe.llm.common import ship

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_embeddings(spark, sf_dir):
    """Near-duplicate groups of all vectors."""
    found = near_embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@query
def op2_bpe(spark, sf_dir):
    """Encode and decode of every document, as digests."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_token_counts(spark, sf_dir):
    """Tokens of every line of all documents, each document encoded as a whole."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = token_counts.section_counts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return found.withColumnRenamed("id", "doc_id").withColumn("n_tokens", F.col("n_tokens").cast("long"))


@query
def op4_simhash(spark, sf_dir):
    """Near-duplicate groups of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))


@query
def op5_fingerprint(spark, sf_dir):
    """Fingerprints of all documents and of their edited versions."""
    return fingerprint.versions(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op6_mixing(spark, sf_dir):
    """Copies of every document under a target entropy, with all tokens of the table as the budget."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    budget = docs.agg(F.sum(mixing.word_count(F.col("text"))).cast("double")).first()[0] or 0.0
    return mixing.mix(docs, mixing.Target(entropy=0.9), budget).drop("text")


@query
def op7_language(spark, sf_dir):
    """Languages of all documents from text, declared language and source."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_text_model(docs)
    found = langid.identify(docs, model, declared_col="lang", host_col="source")
    return found.select("doc_id", "lang", "source", "language", F.round("language_p", 6).alias("language_p"), "language_text")


@query
def op8_licences(spark, sf_dir):
    """Licence notices in all documents."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").withColumn("score", F.round("score", 6))


ORACLES["op8_licences"] = licences.oracle()


@query
def op9_pii(spark, sf_dir):
    """Personal data of all documents."""
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans"
    )


@query
def op10_lm(spark, sf_dir):
    """Scores of all documents under the model of those that are not held out."""
    found = ngram_lm.score(table(spark, sf_dir, "documents"), ngram_lm.every_fifth())
    return found.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_conversations(spark, sf_dir):
    """Faults and cheapest repairs of all conversations, damaged by a rule."""
    damaged = conversations.damaged(table(spark, sf_dir, "conversations"))
    found = conversations.repair_conversations(damaged, present_col="present").conversations
    return found.withColumnRenamed("conv", "conv_id")


@query
def op12_decontamination(spark, sf_dir):
    """Benchmark passages in all documents."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


ORACLES["op12_decontamination"] = decontaminate.oracle()


@query
def op13_runs(spark, sf_dir):
    """Periodic runs of all documents, one of ten with a tail that repeats itself."""
    found = periodic.find_runs(table(spark, sf_dir, "documents"), edit=periodic.looped)
    longest = "array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    found = found.select("*", F.expr(longest).alias("longest"), listed.alias("listed"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("longest.length * 1000 div -longest.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
