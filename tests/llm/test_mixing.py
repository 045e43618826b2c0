import math
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from mendframe.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_exponent(tokens, target, budget):
    """Bisection over the shares, one value at a time."""
    total = sum(tokens)
    shares = [t / total for t in tokens]

    def meets(a):
        z = sum(p**a for p in shares)
        weights = [p**a / z for p in shares]
        if target.entropy is not None:
            return -sum(w * math.log(w) for w in weights) >= target.entropy * math.log(len(shares)) - 1e-12
        epochs = [w / p for w, p in zip(weights, shares, strict=True)]
        return (max(epochs) * budget / total if budget else max(epochs) / min(epochs)) <= target.repetition + 1e-12

    low, high = 0.0, 1.0
    if target.entropy is not None:
        if meets(1.0):
            return 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if meets(mid) else (low, mid)
        return low
    if meets(0.0):
        return 0.0
    if not meets(1.0):
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if meets(mid) else (mid, high)
    return high


TARGETS = [(mixing.Target(entropy=0.9), None), (mixing.Target(entropy=0.97), 5000.0), (mixing.Target(repetition=1.5), 20_000.0), (mixing.Target(repetition=2.0), None)]


@pytest.mark.parametrize("target, budget", TARGETS)
def test_weights_and_budgets(spark, documents, target, budget):
    # one source holds a third of all rows
    docs = documents.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise(F.col("source")))
    mixed = mixing.mix(docs, target, budget)
    rows = mixed.collect()
    assert len(rows) == docs.count()
    tokens, taken, weight = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert r["n_tokens"] == words(r["text"])
        tokens[r["source"]] += r["n_tokens"]
        taken[r["source"]] += r["n_tokens"] * r["copies"]
        weight[r["source"]] = r["weight"]
    names, total = sorted(tokens), sum(tokens.values())
    a = plain_exponent([tokens[n] for n in names], target, budget)
    z = sum((tokens[n] / total) ** a for n in names)
    want = {n: (tokens[n] / total) ** a / z for n in names}
    assert all(abs(weight[n] - want[n]) < 1e-6 for n in names)
    given = budget or max(tokens[n] / want[n] for n in names)
    longest = max(r["n_tokens"] for r in rows)
    for n in names:
        assert taken[n] <= want[n] * given + 2 and taken[n] > want[n] * given - longest - 2
        copies = {r["copies"] for r in rows if r["source"] == n}
        assert len(copies) <= 2 and max(copies) - min(copies) <= 1
    if budget is None:
        assert min(r["copies"] for r in rows) >= 1
    out = mixing.realise(mixed)
    assert out.count() == sum(r["copies"] for r in rows)
    assert out.groupBy("doc_id", "epoch").count().where("count > 1").count() == 0


def test_partial_epoch_is_the_beginning_of_the_permutation(spark, documents):
    rows = mixing.mix(documents, mixing.Target(entropy=0.9), 9000.0).collect()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append((r["copies"], r["doc_id"], r["text"]))
    for group in by_source.values():
        keyed = []
        for copies, doc, text in group:
            h = 42
            for part in (42, str(doc), text):
                raw = part.to_bytes(4, "little") if isinstance(part, int) else part.encode()
                h = xxhash.xxh64_intdigest(raw, h)
            keyed.append((h - 2**64 if h >= 2**63 else h, copies))
        copies = [c for _, c in sorted(keyed)]
        assert copies == sorted(copies, reverse=True)


def test_hostile_rows(hostile, nothing):
    mixed = mixing.mix(hostile, mixing.Target(entropy=0.9))
    assert mixed.columns == [*hostile.columns, "n_tokens", "weight", "copies"]
    rows = mixed.collect()
    assert len(rows) == hostile.count() and all(r["copies"] >= 1 for r in rows)
    assert len({r["copies"] for r in rows if r["doc_id"] == 1}) == 1
    assert mixing.mix(nothing, mixing.Target(repetition=2.0)).count() == 0
    silent = hostile.withColumn("text", F.lit(None).cast("string"))
    assert {(r["copies"], r["weight"]) for r in mixing.mix(silent, mixing.Target(entropy=0.5), 10.0).collect()} == {(1, 0.0)}
