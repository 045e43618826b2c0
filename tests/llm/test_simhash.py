import random
import re

import xxhash
from pyspark.sql import functions as F

from mendframe.llm import simhash


def plain_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    """{fingerprint: smallest reachable fingerprint} by comparing all."""
    codes, root = sorted(set(prints)), {}
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


def expected(rows):
    prints = {(i, n): plain_print(t) for n, (i, t) in enumerate(rows)}
    roots = plain_components(prints.values())
    least = {}
    for (i, _), p in prints.items():
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    return sorted(((i, f"{p:016x}", least.get(roots[p])) for (i, _), p in prints.items()), key=str)


def test_every_pair_within_the_radius_meets():
    generator = random.Random(5)
    for level in range(simhash.LEVELS):
        masks = simhash.masks(level)
        for _ in range(2000):
            a = generator.getrandbits(64)
            b = a
            for bit in generator.sample(range(64), 3):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)
    assert 2 ** simhash.most_left() <= simhash.BUCKET


def test_documents_against_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = simhash.near_duplicates(documents)
    assert sorted((tuple(r) for r in got.select("id", "fingerprint", "component").collect()), key=str) == expected(rows)
    assert got.where("id <> component").count() > 0


def test_hostile_rows(spark, hostile, nothing):
    rows = [(r["doc_id"], r["text"]) for r in hostile.collect()]
    got = simhash.near_duplicates(hostile)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)
    kept = simhash.keep_one(hostile)
    assert kept.columns == hostile.columns
    ids = [r["doc_id"] for r in kept.collect()]
    groups = {r["component"] for r in got.collect()}
    assert sorted(i for i in ids if i is not None) == sorted(g for g in groups if g is not None)
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_hot_buckets_go_down_the_levels(spark):
    """A dense ball of codes with a tiny bucket bound: nothing is lost on any level."""
    generator = random.Random(3)
    centre, codes = generator.getrandbits(64), set()
    for _ in range(400):
        code = centre
        for bit in generator.sample(range(64), generator.randrange(1, 5)):
            code ^= 1 << bit
        codes.add(code)
    codes |= {generator.getrandbits(64) for _ in range(200)}
    frame = spark.createDataFrame([(simhash._signed(c),) for c in codes], "fp long")
    links = simhash.near_links(frame, bucket=4)
    found = {r["node"] % 2**64: r["root"] % 2**64 for r in simhash.components(links).collect()}
    parts = plain_components(codes)
    ours = {}
    for c in codes:
        ours.setdefault(found.get(c, c), set()).add(c)
    theirs = {}
    for c in codes:
        theirs.setdefault(parts[c], set()).add(c)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))
    far = links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 8)
    assert far.count() == 0


def test_one_row_a_group_whatever_the_ids(spark, hostile, nothing):
    texts = {
        "a": "The committee met on Tuesday and agreed to repair the old stone bridge before winter comes.",
        "b": "Seven sailors left the harbour at dawn with bread, rope and a very small lantern.",
        "c": "Prices of copper fell again while markets waited for figures from the larger mines.",
    }
    rows = [(7, "a"), (5, "b"), (7, "b"), (7, "c"), (None, "c"), (None, "a")]
    rows = [(i, texts[t], n) for n, (i, t) in enumerate(rows)]
    rows += [(None, f"{w} stands alone in a text of {w} words about {w} and nothing else", 9) for w in ("iron", "salt", "wool")]
    rows += rows[-1:]
    kept = simhash.keep_one_row(spark.createDataFrame(rows, "doc_id long, text string, n int"))
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(7, texts["a"]), (5, texts["b"]), (7, texts["c"]), *((None, t) for _, t, _ in rows[6:9])], key=str)
    groups = len(set(plain_components([plain_print(r["text"]) for r in hostile.collect()]).values()))
    odd = simhash.keep_one_row(hostile)
    assert odd.columns == hostile.columns and odd.count() == groups
    assert simhash.keep_one_row(nothing).count() == 0
