import math
import zlib
from collections import Counter

import numpy as np
import pytest

from mendframe.llm import ngram_lm as lm


def plain(rows):
    """{position: result} by counting in one place."""
    docs = [((t or "").encode().lower().split() + [b""], i is not None and zlib.crc32(str(i).encode()) % 5 == 1, i) for i, t in rows]
    single, pairs = Counter(), Counter()
    for words, held, _ in docs:
        if not held:
            single.update(words)
            pairs.update(zip([b""] + words[:-1], words, strict=True))
    total, types, after = sum(single.values()), len(single), Counter(h for h, _ in pairs)
    out = []
    for words, held, i in docs:
        base = model = 0.0
        for h, w in zip([b""] + words[:-1], words, strict=True):
            p = (single[w] + 0.5) / (total + 0.5 * (types + 1))
            base += math.log10(p)
            model += math.log10((max(pairs[h, w] - lm.DISCOUNT, 0) + lm.DISCOUNT * after[h] * p) / single[h] if single[h] else p)
        out.append((i, held, len(words), sum(single[w] > 0 for w in words), total, base, model))
    return sorted(out, key=lambda r: (str(r[0]), r[2], r[5]))


def check(df, rows):
    got = [tuple(r) for r in lm.score(df, lm.every_fifth()).select("id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]
    got = sorted(got, key=lambda r: (str(r[0]), r[2], r[5]))
    want = plain(rows)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
        assert a[6] == pytest.approx(b[6], abs=0.02 * b[2])  # codes of one byte
    return got


def test_documents_against_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = check(documents, rows)
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_hot_contexts_over_many_shards(documents, monkeypatch):
    """Shards of 64 tokens: frequent contexts are dealt over several, and nothing changes."""
    monkeypatch.setattr(lm, "SHARD", 2048)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = []
    hot = lm._hot_contexts
    monkeypatch.setattr(lm, "_hot_contexts", lambda *a: found.append(hot(*a)) or found[-1])
    check(documents, rows)
    assert len(found[0]["hash"]) > 3 and found[0]["spread"].max() > 3


def test_hostile_rows(spark, hostile, nothing):
    check(hostile, [(r["doc_id"], r["text"]) for r in hostile.collect()])
    assert lm.score(nothing, lm.every_fifth()).count() == 0
    only_held = hostile.where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")
    rows = [(r["doc_id"], r["text"]) for r in only_held.collect()]
    assert rows
    check(only_held, rows)


def test_probabilities_of_a_context_sum_to_one():
    pass_through = Counter({"a": 3, "b": 1})
    total = sum(pass_through.values())
    seen = sum(c - lm.DISCOUNT for c in pass_through.values()) / total
    assert seen + lm.DISCOUNT * len(pass_through) / total == pytest.approx(1.0)


@pytest.mark.parametrize("size", [1, 2, 7, 1000, 70_000])
def test_elias_fano(size):
    generator = np.random.default_rng(size)
    for bits in (8, 20, 64):
        values = np.sort(generator.integers(0, 2 ** min(bits, 63), size).astype(np.uint64))
        level = lm.EliasFano.of(values, bits)
        assert (level.values() == values).all()
        a, b = sorted(generator.integers(0, size + 1, 2).tolist())
        assert (level.values(a, b) == values[a:b]).all()
        wanted = np.unique(np.concatenate([values, generator.integers(0, 2 ** min(bits, 63), size).astype(np.uint64)]))
        places = level.find(wanted)
        assert ((places >= 0) == np.isin(wanted, values)).all()
        assert (values[places[places >= 0]] == wanted[places >= 0]).all()
    assert lm.EliasFano.of(np.empty(0, np.uint64), 64).find(np.array([3], np.uint64)).tolist() == [-1]


def test_trie_in_files(tmp_path):
    generator = np.random.default_rng(4)
    contexts = np.unique(generator.integers(0, 2**63, 5000).astype(np.uint64))
    sizes = generator.integers(1, 40, len(contexts))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    tokens = np.concatenate([np.sort(generator.choice(2**40, n, replace=False)) for n in sizes]).astype(np.uint64)
    log_p = -generator.random(len(tokens)) * 5
    trie = lm.Trie.build(contexts, starts, tokens, log_p).mapped(str(tmp_path))
    assert isinstance(trie.token.low, np.memmap)
    place = trie.context.find(contexts)
    assert (place == np.arange(len(contexts))).all() and (trie.successors(place) == sizes).all()
    owner = np.repeat(place, sizes)
    codes = trie.lookup(owner, tokens)
    low, step = trie.scale
    assert np.abs(low + (codes.astype(float) - 1) * step - log_p).max() <= step / 2 + 1e-9
    assert (trie.lookup(owner, tokens + np.uint64(1 << 41)) == 0).all()
