import re

import duckdb

from mendframe.llm import licences


def plain(text):
    text = re.sub("[^a-z0-9\n]+", " ", (text or "").lower())
    units = text.split("\n") + [b.replace("\n", " ") for b in re.split("\n(?: ?\n)+", text)]
    units = {" ".join(u.split()) for u in units} - {""}
    best, names, matches = (0.0, ""), set(), 0
    for unit in units:
        ours, hit = licences.bigrams_of(unit), False
        for name, template in licences.TEMPLATES:
            theirs = licences.bigrams_of(template)
            score = 2 * len(ours & theirs) / (len(ours) + len(theirs)) if ours else 0.0
            if score >= licences.LEAST:
                hit = True
                names.add(name)
                if score > best[0] or score == best[0] and name < best[1]:
                    best = (score, name)
        matches += hit
    score, name = best
    return len(units), matches, name or None, round(score, 6) if name else None, ",".join(sorted(names))


def got(df):
    rows = licences.scan(df).collect()
    return sorted(
        ((r["id"], r["n_units"], r["n_matches"], r["licence"], round(r["score"], 6) if r["licence"] else None, r["licences"]) for r in rows), key=str
    )


def test_against_brute_force(documents, hostile, nothing):
    for table in (documents, hostile):
        assert got(table) == sorted(((r["doc_id"], *plain(r["text"])) for r in table.collect()), key=str)
    assert got(nothing) == []


def test_notices_and_near_notices(spark):
    texts = [
        "Some words.\nLICENSED under the Apache License -- version 2.0\nmore",
        "Licensed under the Apache License version 2",
        "the mit license is released under",
        "Copyright\n\n" + licences.TEMPLATES[1][1].replace("; ", ";\n") + "\n\nCode.",
        licences.TEMPLATES[5][1].replace("either version 3", "version 3"),
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["id"]: r["licence"] for r in licences.scan(frame).collect()}
    assert found == {0: "Apache-2.0", 1: "Apache-2.0", 2: None, 3: "Apache-2.0", 4: "GPL-3.0"}


def test_sql_gives_the_same(spark, folder):
    from mendframe.llm.queries import ORACLES, REGISTRY

    ours = REGISTRY["op8_licences"](spark, folder)
    with duckdb.connect() as engine:
        engine.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        theirs = engine.execute(ORACLES["op8_licences"])
        names = [d[0] for d in theirs.description]
        assert names == ours.columns
        assert sorted(map(str, theirs.fetchall())) == sorted(str(tuple(r)) for r in ours.collect())
    assert "Python" not in ours._jdf.queryExecution().toString()
