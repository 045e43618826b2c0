import hashlib
import re

import pytest
from pyspark.sql import functions as F

from mendframe.llm import decontaminate
from mendframe.llm.queries import REGISTRY

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, benchmark, window=10):
    items = []
    for item, text in benchmark:
        words = words_of(text)
        n = min(len(words), window)
        items += [(item, tuple(words[i : i + n])) for i in range(len(words) - n + 1 if n else 0)]
    out = []
    for doc_id, text in docs:
        words, hit, names = words_of(text), set(), set()
        by_length = {}
        for item, w in set(items):
            if len(w) not in by_length:
                by_length[len(w)] = {}
                for i in range(len(words) - len(w) + 1):
                    by_length[len(w)].setdefault(tuple(words[i : i + len(w)]), []).append(i)
            for i in by_length[len(w)].get(w, ()):
                hit.update(range(i, i + len(w)))
                if item is not None:
                    names.add(str(item))
        out.append((doc_id, len(words), len(hit), len(names), sorted(names), bool(hit)))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()), key=repr)


BENCH = [
    (1, "One two three four five six seven eight nine ten eleven twelve."),
    (1, "a second text of item one"),
    (2, "three FOUR five six seven eight nine ten eleven twelve thirteen"),
    (3, "short one"),
    (4, None),
    (5, " ... "),
    (None, "nameless words here"),
    (30, "Ünïcode wörter sind wörter"),
    (30, "Ünïcode wörter sind wörter"),
]
DOCS = [
    (1, "Before: one two-three four five. six SEVEN eight nine ten eleven! after"),
    (1, "Before: one two-three four five. six SEVEN eight nine ten eleven! after"),
    (1, "something else, a short ONE"),
    (2, None),
    (None, "three four five six seven eight nine ten eleven twelve thirteen"),
    (3, ""),
    (4, "short"),
    (5, "x ünïcode wörter sind wörter y"),
    (6, "x Ünïcode Wörter sind wörter y; nameless words here"),
    (7, "short one " * 4000),
]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(*d, "x", 1, "y") for d in DOCS], "doc_id long, text string, id string, at int, words string")
    return docs, spark.createDataFrame(BENCH, "item_id long, text string")


def test_small_tables(tables):
    assert rows(decontaminate.scan(*tables)) == expected(DOCS, BENCH)
    assert rows(decontaminate.scan(*tables, window=3)) == expected(DOCS, BENCH, 3)


def test_a_benchmark_too_large_to_broadcast(tables, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert rows(decontaminate.scan(*tables)) == expected(DOCS, BENCH)


def test_query_equals_brute_force(spark, folder, documents):
    benchmark = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    wanted = expected([(r["doc_id"], r["text"]) for r in documents.collect()], benchmark)
    found = sorted((tuple(r) for r in REGISTRY["op12_decontamination"](spark, folder).collect()), key=repr)
    assert found == sorted(((*w[:4], hashlib.sha256(",".join(w[4]).encode()).hexdigest(), w[5]) for w in wanted), key=repr)
    assert sum(w[5] for w in wanted) > 0


def test_documents_go_or_lose_their_spans(tables):
    docs, benchmark = tables
    clean = [d for d in DOCS if not expected([d], BENCH)[0][5]]
    left = decontaminate.decontaminate(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted((tuple(r)[:2] for r in left.collect()), key=repr) == sorted(clean, key=repr)
    cut = decontaminate.decontaminate(docs, benchmark, "spans")
    assert cut.columns == docs.columns and cut.count() == len(DOCS)
    texts = [r["text"] for r in cut.where("doc_id = 1").orderBy(F.length("text").desc()).collect()]
    assert texts == ["something else, a ", "Before: after", "Before: after"]
    assert [r["text"] for r in cut.where("doc_id = 7").collect()] == [""]
    assert rows(decontaminate.scan(cut, benchmark)) == expected([(r["doc_id"], r["text"]) for r in cut.collect()], BENCH)
    assert decontaminate.decontaminate(docs, benchmark, least=8001).count() == docs.count()


@pytest.mark.parametrize("which", ["hostile", "nothing"])
def test_odd_rows(spark, request, tables, which):
    docs = request.getfixturevalue(which)
    found = rows(decontaminate.scan(docs, tables[1]))
    assert found == expected([(r["doc_id"], r["text"]) for r in docs.collect()], BENCH)
    empty = tables[1].limit(0)
    assert {r[2] for r in rows(decontaminate.scan(docs, empty))} <= {0}
    assert decontaminate.decontaminate(docs, empty, "spans").exceptAll(docs).isEmpty()
