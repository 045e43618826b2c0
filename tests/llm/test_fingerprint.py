import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from mendframe.llm import fingerprint


def paragraphs(text):
    return {p for p in re.split(r"\n+|(?<=[.!?])[ \t\n\x0b\f\r]+", text) if p}


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    def order(row):
        key = row[0] if row[0] is not None else -(2**63)
        mixed = xxhash.xxh64_intdigest((row[1] or "").encode(), 42)
        return -key, mixed - 2**64 if mixed >= 2**63 else mixed

    rows = sorted(((i, t or "") for i, t in rows), key=order)
    out = []
    for at, (i, text) in enumerate(rows):
        after, third = rows[(at + 1) % len(rows)][1], len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        near = [round(alike(paragraphs(text), paragraphs(t)), 9) for t in (edited, after)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return sorted(out, key=str)


def got(df):
    rows = fingerprint.versions(df).collect()
    return sorted(((r["id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows), key=str)


def test_documents_against_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(documents) == expected(rows)


def test_hostile_rows(hostile, nothing):
    assert got(hostile) == expected([(r["doc_id"], r["text"]) for r in hostile.collect()])
    assert fingerprint.versions(nothing).count() == 0
    one = hostile.where("doc_id = 8")
    assert got(one) == expected([(r["doc_id"], r["text"]) for r in one.collect()])


def test_equal_texts_have_equal_fingerprints(hostile):
    prints = fingerprint.fingerprints(hostile, "text", "id")
    assert prints.columns == [c for c in hostile.columns if c != "id"] + ["id"]
    by_text = prints.groupBy(F.coalesce("text", F.lit(""))).agg(F.countDistinct("id").alias("n"))
    assert by_text.where("n > 1").count() == 0
    assert prints.select("id").distinct().count() > 6


def differing(spark):
    """Pairs of arrays of digests, with the signed digests in which they differ."""
    rows, names = [], iter(range(10**6))
    for shared in (0, 1, 7, 60, 500):
        for ours in (0, 1, 3, 40, 300):
            for theirs in (0, 2, 45):
                common = [next(names) for _ in range(shared)]
                only = [next(names) for _ in range(ours)], [next(names) for _ in range(theirs)]
                rows.append((common + only[0], common + only[1], *only))
    frame = spark.createDataFrame(rows, "a array<long>, b array<long>, x array<long>, y array<long>")
    frame = frame.select(*[F.transform(c, lambda v: F.xxhash64(v)).alias(c) for c in "abxy"])
    signed = "array_sort(concat(transform(x, d -> named_struct('d', d, 's', 1)), transform(y, d -> named_struct('d', d, 's', -1))))"
    return frame.withColumns({"want": F.expr(signed), "n": F.expr("size(x) + size(y)")})


def test_peeling_recovers_the_digests(spark):
    """Differences from none to hundreds: the digests themselves come back, whatever the size of sketch it takes."""
    frame = differing(spark)
    got = frame.withColumn("got", F.expr(f"array_sort({fingerprint.difference('a', 'b')})"))
    assert got.where("got <> want or got is null").count() == 0
    small = fingerprint.peeled(fingerprint.subtracted(fingerprint.sketch("a"), fingerprint.sketch("b")))
    first = frame.withColumn("got", F.expr(f"array_sort({small})"))
    assert first.where("n <= 2 and got is null").count() <= 1
    assert first.where("n > 100 and got is not null").count() == 0
    assert first.where("got <> want").count() == 0


def test_a_stalled_sketch_is_rebuilt_wider(spark):
    """At one width these digests stall; each doubling that peels gives the same digests."""
    frame = differing(spark).where("n between 40 and 90")
    peels = []
    for width in (8, 16, 32, 64, 128):
        w = f"{width}L"
        sql = fingerprint.peeled(fingerprint.subtracted(fingerprint.sketch("a", w, w), fingerprint.sketch("b", w, w)), w, w)
        at = frame.withColumn("got", F.expr(f"array_sort({sql})"))
        assert at.where("got <> want").count() == 0
        peels.append(at.where("got is not null").count())
    assert peels[0] == 0 and peels[-1] == frame.count()


def test_stored_fingerprints_can_be_subtracted(spark):
    base = [f"Sentence {i}." for i in range(40)]
    texts = [(1, " ".join(base)), (2, " ".join(base[:7] + ["Another one."] + base[8:])), (3, " ".join(f"Other {i}." for i in range(40))), (4, None)]
    prints = fingerprint.fingerprints(spark.createDataFrame(texts, "id int, text string"))
    digest = {p: xxhash.xxh64_intdigest(p.encode(), 42) for p in (base[7], "Another one.")}
    signed = {p: d - 2**64 if d >= 2**63 else d for p, d in digest.items()}
    pairs = prints.select("id", F.col("fingerprint").alias("a")).crossJoin(prints.select(F.col("id").alias("other"), F.col("fingerprint").alias("b")))
    got = {(r["id"], r["other"]): r["d"] for r in pairs.withColumn("d", fingerprint.stored_difference("a", "b")).collect()}
    assert {(x["d"], x["s"]) for x in got[1, 2]} == {(signed[base[7]], 1), (signed["Another one."], -1)}
    assert got[1, 1] == [] and got[4, 4] == [] and got[1, 3] is None and got[1, 4] is None


def test_no_python_in_the_plan(documents):
    plan = fingerprint.versions(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
