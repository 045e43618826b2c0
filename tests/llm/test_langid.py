import pytest
from pyspark.sql import functions as F

from mendframe.llm import langid


@pytest.fixture(scope="module")
def halves(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")


@pytest.fixture(scope="module")
def model(halves):
    return langid.fit_text_model(halves[0])


def test_held_out_accuracy(halves, model):
    held = halves[1]
    found = langid.identify(held, model)
    right = found.agg(F.avg((F.col("language") == F.col("lang")).cast("double"))).first()[0]
    assert right >= 0.98
    assert found.count() == held.count()


def test_foreign_and_junk_texts_are_unknown(spark, model):
    texts = [(0, "zxq wkv qqz xkcd vvw zzzq jjx qxz wvk xxq kkz " * 5), (1, "1234 5678 !!!"), (2, None), (3, "")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in langid.identify(frame, model).collect()}
    assert rows[0]["language"] == langid.UNKNOWN
    assert all(rows[i]["language_text"] is None for i in (1, 2, 3))
    assert langid.keep_identified(frame, model).count() == 0


def test_evidence_decides_where_the_text_is_silent(spark, halves, model):
    """A host's documents are all French, its suffix too: a text without letters follows them."""
    french = halves[1].where("lang = 'fr'").select("text", F.lit("fr").alias("declared"), F.lit("fr").alias("suffix"), F.lit("h1").alias("host"))
    others = halves[1].where("lang <> 'fr'").select("text", F.col("lang").alias("declared"), F.lit("com").alias("suffix"), F.lit("h2").alias("host"))
    silent = spark.createDataFrame(
        [("12 34", None, None, "h1"), ("12 34", "FR-fr", None, None), ("12 34", None, "FR", None), ("12 34", None, None, "h2"), ("12 34", None, "fr", "new")],
        "text string, declared string, suffix string, host string",
    )
    table = french.unionByName(others).unionByName(silent)
    found = langid.identify(table, model, declared_col="declared", suffix_col="suffix", host_col="host")
    assert {r["language"] for r in found.where("host = 'h1' and text = '12 34'").collect()} == {"fr"}
    assert {r["language"] for r in found.where("declared = 'FR-fr' or suffix = 'FR' or host = 'new'").collect()} == {"fr"}
    assert {r["language"] for r in found.where("host = 'h2' and text = '12 34'").collect()} == {"en"}
    text = halves[1].where("lang = 'de' and length(text) > 500").first()["text"]
    odd = table.unionByName(spark.createDataFrame([(text, "fr", "fr", "h1")], table.schema))
    told = langid.identify(odd, model, declared_col="declared", suffix_col="suffix", host_col="host")
    assert told.where(F.col("text") == text).where("host = 'h1'").first()["language"] == "de"


def test_hostile_rows(spark, hostile, nothing, model):
    found = langid.identify(hostile, model, declared_col="lang", host_col="source")
    assert found.columns == [*hostile.columns, "language", "language_p", "language_text"]
    rows = found.collect()
    assert len(rows) == hostile.count()
    assert all(0 < r["language_p"] <= 1 for r in rows)
    assert len({(r["language"], r["language_p"]) for r in rows if r["doc_id"] == 1}) == 1
    assert langid.identify(nothing, model, declared_col="lang", host_col="source").count() == 0
    kept = langid.keep_identified(hostile, model, declared_col="lang", host_col="source")
    assert kept.columns == hostile.columns
    empty = langid.fit_text_model(nothing)
    assert empty.languages == [langid.UNKNOWN]
    assert {r["language"] for r in langid.identify(hostile, empty).collect()} == {langid.UNKNOWN}


def test_long_texts_are_read_in_parts(monkeypatch, model):
    text = "les documents de la langue française sont écrits " * 300
    whole = model.scores(text)
    monkeypatch.setattr(langid, "PART", 1000)
    assert abs(model.scores(text) - whole).max() < 0.05 * abs(whole).max()


def test_rare_languages_are_known_in_a_large_corpus(spark, halves, monkeypatch):
    """A handful of rows among many, and more than 64 labels: all are in the model and their documents stay."""
    monkeypatch.setattr(langid, "SAMPLE", 20)
    rare = [(f"þetta er íslenskur texti um veðrið og sjóinn við ströndina þar sem bátar liggja í höfn {w}", "is") for w in ("núna", "enn", "oft")]
    labels = [("xqzj wvkq " * 20 + f"{chr(97 + i // 26)}{chr(97 + i % 26)}" * 40, f"q{chr(97 + i // 26)}{chr(97 + i % 26)}") for i in range(70)]
    few = spark.createDataFrame(rare + labels * 4, "text string, lang string")
    table = halves[0].select("text", "lang").unionByName(few)
    model = langid.fit_text_model(table)
    assert {"is", *(name for _, name in labels)} <= set(model.languages)
    assert {r["language"] for r in langid.identify(few.where("lang = 'is'"), model).collect()} == {"is"}
    assert langid.keep_identified(table, model, declared_col="lang").where("lang = 'is'").count() == len(rare)
