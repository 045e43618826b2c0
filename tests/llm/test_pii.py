import math
import random
import re

from pyspark.sql import functions as F

from mendframe.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            keep = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if keep:
                out.append((kind, m.start(), m.end()))
    return out


ODD = [
    "a@b@c.de x@y.z.w@q.r", "..@a.b -@-.- a@b. a@.b @a.b", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3 12.3.4.5.", "é1.1.1.1é",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111111", "1 2  3 4-5--6", "+1 (555) 123-4567. +12 +1234567890123456 ++49 30 1234567",
    "+1" + " " * 50 + "x", "4111111111111111+49 30 1234567", "user@example.com" * 3, "0.0.0.0@a.b",
]


def test_base_patterns(documents):
    for text in ODD + [r["text"] for r in documents.collect()]:
        assert pii.base_spans(text) == plain(text), text[:80]


def test_long_runs_are_linear():
    text = "a" * 200_000 + " " + "1" * 200_000 + "@" + "1." * 100_000 + "+1" * 50_000
    assert pii.base_spans(text)[0][0] == "email"


def test_find_against_brute_force(documents, hostile, nothing):
    for table in (documents, hostile):
        rows = pii.find(table).collect()
        assert len(rows) == table.count()
        want = sorted((str(r["doc_id"]), pii.joined(plain(r["text"]))) for r in table.collect())
        assert sorted((str(r["id"]), r["base"]) for r in rows) == want
        for r in rows:
            assert r["spans"].startswith(r["base"])
            assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in r["base"].split(",")) for k in pii.KINDS]
    assert pii.find(nothing).count() == 0 and pii.sanitise(nothing).count() == 0


def corpus(spark):
    """One address stands by "wolfsburg" in many contexts, a word met nowhere else, and by common words."""
    rows = []
    for i in range(40):
        filler = f"alpha{chr(97 + i % 20)} beta{chr(97 + i % 7)} the report of"
        if i < 8:
            rows.append((i, f"{filler} wolfsburg agent jane@corp.example said the plan{chr(97 + i)} works"))
        else:
            rows.append((i, f"{filler} agent nobody said the plan works"))
    rows += [(100 + i, rows[0][1]) for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_disclosing_terms(spark):
    table = corpus(spark)
    found = {r["id"]: r for r in pii.find(table).collect()}
    for r in table.collect():
        terms = [s.split(":") for s in found[r["doc_id"]]["spans"].split(",") if s.startswith("term")]
        named = {r["text"][int(a) : int(b)] for _, a, b in terms}
        assert named == ({"wolfsburg"} if "jane@" in r["text"] else set())


def test_contexts_of_copies_count_once(spark):
    text = "secretword agent jane@corp.example said"
    table = spark.createDataFrame([(i, text) for i in range(50)] + [(100 + i, "agent said") for i in range(50)], "doc_id long, text string")
    assert pii.find(table).where(F.col("spans").contains("term")).count() == 0


def test_sanitised_texts(spark, hostile):
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(corpus(spark)).collect()}
    assert "wolfsburg" not in "".join(clean.values()) and "jane" not in "".join(clean.values())
    assert "<term> agent <email> said" in clean[0]
    odd = pii.sanitise(hostile)
    assert odd.columns == hostile.columns and odd.count() == hostile.count()
    changed = {r["doc_id"] for r in odd.join(hostile, [F.coalesce(odd["text"], F.lit("")) == F.coalesce(hostile["text"], F.lit(""))], "left_anti").collect()}
    assert changed == {8}
    assert pii.replaced("0123456789", "email:2:5,ip:4:6,term:8:9") == "01<email>67<term>9"


def test_disclosing_terms_are_marked_wherever_they_stand(spark):
    """The term is told by documents, not by a window: far from the entity, in another line, and where no entity stands."""
    gap = " ".join(["the report of nobody said"] * 4)
    rows = [(i, f"start{chr(97 + i)} agent jane@corp.example said{chr(97 + i)}.\n{gap}. Wolfsburg works, {gap} wolfsburg") for i in range(8)]
    rows += [(50, f"no address here but wolfsburg and {gap}")] + [(100 + i, f"agent {gap} works here no address but and start") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["id"]: r["spans"] for r in pii.find(table).collect()}
    for i, text in rows:
        named = [text[int(a) : int(b)].lower() for k, a, b in (s.split(":") for s in found[i].split(",") if s) if k == "term"]
        assert named == ["wolfsburg"] * text.lower().count("wolfsburg")
    assert "wolfsburg" not in "".join(r["text"].lower() for r in pii.sanitise(table).collect())


def plain_terms(rows):
    """Disclosing terms by counting sets of documents, with nothing folded, hashed or pruned."""
    holds, held, windows = {}, {}, {}
    for i, (_, text) in enumerate(rows):
        text = text or ""
        spans = plain(text)
        words = [(m[0].lower(), m.start()) for m in re.finditer(r"[^\W\d_]+", text) if not any(a < m.end() and m.start() < b for _, a, b in spans)]
        for m in re.finditer(r"[^\W\d_]+", text):
            holds.setdefault(m[0].lower(), set()).add(i)
        for kind, a, b in spans:
            e = pii.entity(kind, text[a:b])
            before, after = [w for w, at in words if at < a][-pii.WINDOW :], [w for w, at in words if at >= b][: pii.WINDOW]
            near = tuple(before + after)
            held.setdefault(e, {}).setdefault(i, {w for w, _ in words})
            for w in near:
                windows.setdefault((e, w), set()).add(near)
    return holds, held, windows


def test_terms_against_brute_force(spark):
    rnd = random.Random(9)
    common = [f"common{a}{b}" for a in "abcdef" for b in "uvwxyz"]
    rows = []
    for i in range(400):
        words = rnd.choices(common, k=rnd.randint(5, 60))
        for who in range(12):
            if rnd.random() < 0.04:
                words.insert(rnd.randrange(len(words)), f"user{who}@site.example")
                if rnd.random() < 0.95:  # a secret of this person, near or far
                    words.insert(rnd.randrange(len(words)), f"Secret{chr(97 + who)}" + "x" * 600 * (who == 3))
            elif rnd.random() < 0.004:
                words.append(f"secret{chr(97 + who)}")
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[i % 7][1]) for i in range(30)] + [(2000, None), (2001, "")]
    total, (holds, held, windows) = len(rows), plain_terms(rows)
    telling = set()
    for e, texts in held.items():
        for t in set().union(*texts.values()):
            both = [i for i, words in texts.items() if t in words]
            score = math.log(len(both) * total / (len(texts) * len(holds[t]))) / -math.log(len(texts) / total)
            if score >= pii.THRESHOLD and max(len(windows.get((e, t), ())), len({rows[i][1] for i in both})) >= pii.SUPPORT:
                telling.add(t)
    assert len(telling) > 5 and any(len(t) > 600 for t in telling)
    found = {r["id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        named = [(text or "")[int(a) : int(b)].lower() for k, a, b in (s.split(":") for s in found[i].split(",") if s) if k == "term"]
        words = [m[0].lower() for m in re.finditer(r"[^\W\d_]+", text or "")]
        assert named == [w for w in words if w in telling], i


def test_windows_take_whole_words_however_long():
    """Two words of hundreds of letters, and a wide gap, do not cut a context."""
    text = "a" * 300 + " " + "b" * 500 + " " * 900 + "jane@corp.example, x@y.z " + "c" * 700 + " d"
    _, _, _, _, _, _, near, _ = pii._analysed(text)
    assert [n[2] for n in near] == [["a" * 300, "b" * 500, "c" * 700, "d"]] * 2
