import importlib
import re
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from mendframe.llm import pii, simhash


def test_stages_follow_each_other(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    outputs = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        outputs[name] = docs
        if name != "tokens":
            assert docs.columns == columns, name
    every = outputs["language"]
    assert every.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    groups = simhash.near_duplicates(every)
    kept = sorted(r["doc_id"] for r in outputs["near_duplicates"].collect())
    assert kept == sorted({r["component"] for r in groups.collect()}) and len(kept) < every.count()
    clean = outputs["personal_data"]
    assert clean.count() == len(kept)
    for r in clean.collect():
        assert r["n_chars"] == len(r["text"])
        assert not [s for s in pii.base_spans(r["text"]) if s[0] in ("email", "ip", "card")]
    mixed = outputs["source_mix"]
    assert mixed.select("doc_id").distinct().count() == len(kept)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    for r in outputs["tokens"].collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
    assert outputs["tokens"].count() == mixed.count()


def test_run_is_the_stages(spark, folder):
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]
    assert result.where(F.length("ids") != F.col("n_tokens") * 4).count() == 0


@pytest.mark.parametrize("which", ["hostile", "nothing"])
def test_odd_tables(spark, folder, request, which):
    docs = request.getfixturevalue(which)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        docs.count()


def test_columns_of_the_same_names_as_the_operators_pass(spark, folder):
    extra = ["language", "language_p", "weight", "epoch", "copies", "n_tokens", "id", "component", "fingerprint", "text_hash"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id")) for c in extra}).cache()
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns, name
        wrong = " or ".join(f"{c} is null or {c} <> concat('{c}-', doc_id)" for c in extra)
        assert docs.count() and docs.where(wrong).isEmpty(), name


def test_entry_without_the_subpackage(monkeypatch):
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in entry.queries()} and "pipeline" in entry.queries()
    for name in [n for n in sys.modules if n.startswith("mendframe.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "mendframe.llm", None)
    bare = importlib.reload(entry)
    try:
        assert not [k for k in bare.queries() if re.match(r"op\d|pipeline", k)]
        assert not [k for k in bare.oracle_sql() if re.match(r"op\d|pipeline", k)]
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
