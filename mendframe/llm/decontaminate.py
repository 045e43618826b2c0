"""Benchmark decontamination: document windows looked up in a broadcast hash set of benchmark windows.

Texts are lower-cased (A-Z) and cut into words: stretches of ASCII letters, digits and characters
beyond ASCII. A benchmark window is WINDOW consecutive words of an item, or the whole of a shorter
item. Every document window of a length that the benchmark has is hashed and looked up; a hit is
verified word by word. Everything is built-in expressions; the texts are scanned once and never
shuffled: what leaves a scan is one row a document and the hits, folded within the task.
"""

from __future__ import annotations

import functools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendframe.llm.common import drop_stored, stored

WINDOW = 10
#: The hash set is broadcast up to this many bytes of words and hashes; beyond, hits are found by a shuffled join.
BROADCAST_BYTES = 32 << 20
#: Results of so many different sets of hit windows are broadcast to the documents; each is some 150 bytes.
BROADCAST_SETS = 100_000
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A word with what stands between it and the next one, and what stands before the first.
PIECES = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
LEADING = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def words_of(text: Column) -> Column:
    """The words of a text in order, lower-cased (A-Z); none of a null. Only words with capitals go through the letter table."""

    def lowered(word: Column) -> Column:
        return F.when(F.lower(word) == word, word).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))

    words = F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS)
    return F.transform(F.filter(words, lambda w: w != ""), lowered)


def _hash(words: Column, start: Column, length: Column, window: int) -> Column:
    """Hash of the `length` words from number `start` on: nulls, as those beyond, leave a hash as it is."""
    return F.xxhash64(*[F.when(length > i, F.get(words, start + i)) for i in range(window)])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each different window: hash, window (its words), length, items (ids as strings, sorted), held (digest of items).

    Items without a word have no window; an item without id has windows, but no name in items.
    """
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    rows = rows.withColumn("length", F.least(F.size("words"), F.lit(window)))
    rows = rows.select("item", "words", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("at"))
    rows = rows.select("item", "length", F.slice("words", F.col("at"), F.col("length")).alias("window"))
    rows = rows.groupBy("window", "length").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return rows.select(_hash(F.col("window"), F.lit(0), F.col("length"), window).alias("hash"), "window", "length", "items", F.sha2(F.to_json("items"), 256).alias("held"))


def _shape(windows: DataFrame) -> tuple[list[int], bool]:
    """Lengths of the windows (WINDOW different ones at most), and whether the set may be broadcast."""
    size = F.length(F.array_join("window", " ")) + 64
    rows = windows.groupBy("length").agg(F.sum(size).alias("bytes")).collect()
    return sorted(r["length"] for r in rows), sum(r["bytes"] for r in rows) <= BROADCAST_BYTES


def _found(df: DataFrame, windows: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row for each (task, id, text): id, digest, n_words, copies, covered (numbers of hit words), held (digests of item sets)."""
    lengths, small = _shape(windows)
    rows = df.select(
        F.spark_partition_id().alias("task"),
        F.col(id_col).alias("id"),
        F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256).alias("digest"),
        words_of(F.col(text_col)).alias("words"),
    )
    # number 0 stands for the document itself, windows of all lengths follow; the generator is an outer one, since
    # for others a filter on the size of its array is inferred and pushed below, where it computes the words once more
    ends = [F.lit(0)]
    for n in lengths:
        ends.append(ends[-1] + F.greatest(F.size("words") - n + 1, F.lit(0)))
    rows = rows.select("task", "id", "digest", F.size("words").alias("n_words"), "words", F.explode_outer(F.sequence(F.lit(0), ends[-1])).alias("at"))
    which = [(F.col("at") <= end, F.col("at") - begin - 1, n) for n, begin, end in zip(lengths, ends[:-1], ends[1:], strict=True)]
    start, length = (functools.reduce(lambda rest, w: F.when(w[0], w[i]).otherwise(rest), which[::-1], F.lit(0)) for i in (1, 2))
    if len(lengths) == 1:
        start, length = F.col("at") - 1, F.lit(lengths[0])
    # the document's own key spreads documents where the join is shuffled
    key = F.when(F.col("at") == 0, F.xxhash64("digest")).otherwise(_hash(F.col("words"), F.col("start"), F.col("n"), window))
    rows = rows.select("task", "id", "digest", "n_words", "words", "at", start.alias("start"), length.alias("n"))
    found = F.when(F.col("at") > 0, F.slice("words", F.col("start") + 1, F.col("n")))
    rows = rows.select("task", "id", "digest", "n_words", "at", "start", "n", key.alias("key"), found.alias("found"))
    table = windows.select("hash", F.col("window").alias("wanted"), F.col("held").alias("held_by"))
    rows = rows.join(F.broadcast(table) if small else table, (F.col("key") == F.col("hash")) & (F.col("at") > 0), "left")
    hit = F.col("wanted").isNotNull() & (F.col("found") == F.col("wanted"))
    rows = rows.where((F.col("at") == 0) | hit)
    found = rows.groupBy("task", "id", "digest", "n_words").agg(
        F.count_if(F.col("at") == 0).alias("copies"),
        F.collect_set(F.when(hit, F.struct("start", "n"))).alias("spans"),
        F.array_sort(F.collect_set(F.when(hit, F.col("held_by")))).alias("held"),
    )
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1))))
    return found.select("id", "digest", "n_words", "copies", covered.alias("covered"), "held")


def scan(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per input row: id, n_words, n_hit, n_items, items (ids of items with a window in the text, sorted as strings), contaminated.

    Null and empty texts have no words and no hits. Null and repeated ids are rows like others: results
    follow the text alone, and equal rows are folded within a task and dealt out again. Texts of any
    length are scanned whole. An empty table gives an empty result, an empty benchmark no hits. Items
    that share an id are one item; items without id hit words, but are not in items. Other columns are
    not read. A benchmark whose windows outgrow BROADCAST_BYTES is joined by a shuffle on the hash.
    """
    windows = stored(benchmark_windows(benchmark, item_col, item_text_col, window), "windows")
    docs = _found(df, windows, id_col, text_col, window).select(
        "id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("covered").cast("long").alias("n_hit"),
        "copies",
        "held",
        F.when(F.size("held") > 0, F.sha2(F.to_json("held"), 256)).otherwise(F.col("digest")).alias("set"),
    )
    docs = stored(docs, "contamination")
    # documents with the same set of hit windows share their items: each set is resolved once
    sets = docs.where(F.size("held") > 0).groupBy("set").agg(F.min("held").alias("held")).select("set", F.explode("held").alias("held"))
    names = windows.select("held", "items").distinct()
    items = sets.join(names, "held").select("set", F.explode("items").alias("item")).groupBy("set")
    items = stored(items.agg(F.array_sort(F.collect_set("item")).alias("items")), "contaminating-items")
    drop_stored(windows)
    held = items.agg(F.count("*"), F.sum(F.length(F.array_join("items", ",")))).first()
    small = held[0] <= BROADCAST_SETS and (held[1] or 0) <= BROADCAST_BYTES
    out = docs.join(F.broadcast(items) if small else items, "set", "left")
    return out.select(
        "id",
        "n_words",
        "n_hit",
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    least: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """`df` without contaminated documents (remove="documents") or with the hit words taken out of them (remove="spans").

    A document counts as contaminated from `least` hit words on. Removing spans drops each hit word with
    what stands between it and the next word and keeps everything else as it was written; a text without
    hits, null or empty stays as it is. All columns and all other rows stay, repeated ones too; equal texts
    are treated alike whatever their ids; an empty table or benchmark changes nothing.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    windows = stored(benchmark_windows(benchmark, item_col, item_text_col, window), "windows")
    hits = _found(df, windows, id_col, text_col, window).where(F.size("covered") >= max(least, 1))
    hits = stored(hits.groupBy("digest").agg(F.min("n_words").alias("_n"), F.min(F.array_sort("covered")).alias("_covered")), "hit-texts")
    drop_stored(windows)
    small = (hits.agg(F.sum(F.size("_covered") * 4 + 100)).first()[0] or 0) <= BROADCAST_BYTES
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    text = names[df.columns.index(text_col)]
    rows = rows.withColumn("digest", F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))
    rows = rows.join(F.broadcast(hits) if small else hits, "digest", "left_anti" if remove == "documents" else "left")
    if remove == "spans":
        # pieces and marks stand side by side in word order: no lambda looks anything up by its number
        pieces = F.regexp_extract_all(F.col(text), F.lit(PIECES), F.lit(0))
        kept = F.array_except(F.sequence(F.lit(0), F.col("_n") - 1), "_covered")
        marks = F.array_sort(F.concat(_marked(kept, True), _marked(F.col("_covered"), False)))
        rest = F.array_join(F.zip_with(pieces, marks, lambda p, m: F.when(m["kept"], p)), "")
        rows = rows.withColumn(text, F.when(F.col("_covered").isNull(), F.col(text)).otherwise(F.concat(F.regexp_extract(text, LEADING, 0), rest)))
    return rows.select(*names).toDF(*df.columns)


def _marked(numbers: Column, kept: bool) -> Column:
    return F.transform(numbers, lambda i: F.struct(i.alias("i"), F.lit(kept).alias("kept")))


def oracle(window: int = WINDOW) -> str:
    """`op12_decontamination` over documents and benchmark as SQL of a second engine."""
    words = r"""regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')""".format(
        string.ascii_uppercase, string.ascii_lowercase
    )
    return f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
cut AS (SELECT item, w, least(len(w), {window}) AS n, unnest(range(1, len(w) - least(len(w), {window}) + 2)) AS i FROM b WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM cut),
lengths AS (SELECT DISTINCT n FROM wanted),
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
placed AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths),
hits AS (
 SELECT r, i, f.n, item FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM placed) f JOIN wanted ON f.t = wanted.t AND f.n = wanted.n
), covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""
