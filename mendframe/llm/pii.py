"""Personal data: exact patterns, and terms whose corpus co-occurrence discloses the entity they stand near.

Information-theoretic sanitisation. An entity is a value that a pattern finds (kind and value). With
p(e) the share of documents that hold entity e, p(t) the share that hold term t, and p(e, t) the share
that hold both, wherever they stand, the disclosure of e by t is PMI(e, t) / IC(e) = log(p(e, t) /
(p(e) p(t))) / -log p(e): 1 where t is met in no other document, 0 where it is independent. Terms of at
least `threshold` with enough support are added as spans of kind "term" in every text that holds them,
with the entity or without, and the sanitised text holds a general label in their place, as for the
entity itself.

Support is SUPPORT different contexts of e: its windows that hold t, or its documents that hold t, each known by
one of its windows. A window is the WINDOW nearest whole words on either side that are in no span, however far or
long they are. Copies of a context count once.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.llm.common import stored

KINDS = ["email", "ip", "card", "phone"]
WINDOW = 6
SUPPORT = 3
THRESHOLD = 0.8
CELLS = 1 << 22
FLUSH = 1 << 16
SLICE = 256

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the first digit of a run is where a leftmost match begins, so a look behind saves all later starts
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _at_most_255(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @: linear even in a run of a million name characters."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append((start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then by start; matches that fail their test are dropped."""
    spans = [("email", a, b) for a, b in _emails(text)]
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_at_most_255(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return spans


def entity(kind: str, value: str) -> str:
    """One name for all spellings of a value."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else _digits(value)}"


def places(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """All words of a text, lower-cased with their places, but for those that overlap a span."""
    spans, at = sorted(taken), 0
    for m in _WORD.finditer(text):
        while at < len(spans) and spans[at][1] <= m.start():
            at += 1
        if not any(a < m.end() and m.start() < b for a, b in spans[at : at + len(KINDS)]):
            yield m[0].lower(), m.start(), m.end()


def context(words: list[tuple[str, int, int]], starts: list[int], start: int, window: int = WINDOW) -> list[str]:
    """The words around a span, given all `places` of its text and where they start."""
    at = bisect_left(starts, start)
    return [w for w, _, _ in words[max(0, at - window) : at + window]]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_ROW = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [
        T.StructField("base", T.StringType()),
        T.StructField("hash", T.LongType()),
        T.StructField(
            "near",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("entity", T.StringType()),
                        T.StructField("context", T.LongType()),
                        T.StructField("terms", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        ),
        T.StructField("words", T.ArrayType(T.StringType())),
    ]
)


def _analysed(text: str | None) -> tuple:
    text = text or ""
    spans = base_spans(text)
    taken = [(a, b) for _, a, b in spans]
    found = list(places(text, taken)) if spans else []
    starts, near = [a for _, a, _ in found], []
    for kind, a, b in spans:
        terms = context(found, starts, a)
        mark = xxhash.xxh64_intdigest(" ".join(terms)) - (1 << 63)
        near.append((entity(kind, text[a:b]), mark, terms))
    counts = Counter(k for k, _, _ in spans)
    digest = xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)
    words = sorted({w for w, _, _ in found})
    return (*[counts[k] for k in KINDS], joined(spans), digest, near, words)


def _marked(terms: DataFrame):
    """A shared bitmap of fixed size (CELLS bits, packed) that marks the hashes of `terms`: it leaves out nearly all other words."""
    marks = terms.select(F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(CELLS)).cast("long").alias("cell"))
    words = marks.groupBy((F.col("cell") / 62).cast("long").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell % 62 as int))")).alias("bits"))
    cells = np.zeros(CELLS + 62, dtype=bool)
    for row in words.toLocalIterator():
        for bit in range(62):
            cells[row["at"] * 62 + bit] = row["bits"] >> bit & 1
    return terms.sparkSession.sparkContext.broadcast(np.packbits(cells).tobytes())


def _is_marked(bits: bytes, word: str) -> bool:
    cell = crc32(word.encode("utf-8", "replace")) % CELLS
    return bool(bits[cell >> 3] >> (7 - (cell & 7)) & 1)


def _everywhere(df: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """(hash, added): the places of all `terms` in every text that holds one, over all rows."""
    shared = _marked(terms)

    def find_places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, known = shared.value, {}

        def hit(word: str) -> bool:
            if word not in known:
                if len(known) >= FLUSH:
                    known.clear()
                known[word] = _is_marked(bits, word)
            return known[word]

        def gathered(rows: list[tuple[str, int, int, int]]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["term", "start", "end", "hash"])

        for batch in batches:
            rows = []
            for text in batch["text"]:
                text = text or ""
                if not any(hit(w) for w in {w.lower() for w in _WORD.findall(text)}):
                    continue
                digest = xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)
                taken = [(a, b) for _, a, b in base_spans(text)]
                rows += [(w, a, b, digest) for w, a, b in places(text, taken) if hit(w)]
                if len(rows) >= FLUSH:
                    yield gathered(rows)
                    rows = []
            if rows:
                yield gathered(rows)

    found = df.select(F.col(text_col).alias("text")).mapInPandas(find_places, "term string, start long, end long, hash long")
    return found.join(terms, "term").groupBy("hash").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("added"))


def _document_counts(df: DataFrame, text_col: str, candidates: DataFrame) -> DataFrame:
    """(term, n): in how many rows of `df` each candidate term stands, over all rows.

    What slips through the bitmap falls in the join with the candidates.
    """
    shared = _marked(candidates)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, counts = shared.value, Counter()

        def flushed() -> pd.DataFrame:
            out = pd.DataFrame({"term": list(counts), "n": list(counts.values())}).astype({"term": object, "n": "int64"})
            counts.clear()
            return out

        known: dict[str, bool] = {}
        for batch in batches:
            for text in batch["text"]:
                for word in {w.lower() for w in set(_WORD.findall(text or ""))}:
                    hit = known.get(word)
                    if hit is None:
                        if len(known) >= FLUSH:
                            known.clear()
                        hit = known[word] = _is_marked(bits, word)
                    if hit:
                        counts[word] += 1
                if len(counts) >= FLUSH:
                    yield flushed()
        yield flushed()

    found = df.select(F.col(text_col).alias("text")).mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return candidates.select("term").distinct().join(found, "term")


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, hash (of the text), n_email, n_ip, n_card, n_phone, base and spans.

    `base` and `spans` list kind:start:end in code points, comma-joined: the base spans by kind as
    listed and start, in `spans` followed by the added terms by start: every place of every disclosing term,
    also in texts that do not hold the entity. Null texts count as empty and
    have no span. Null and repeated ids are kept; equal
    texts have equal spans. Whole texts are read. An empty table gives an empty result. Other columns
    of `df` are not read.
    """

    @F.pandas_udf(_ROW)
    def analysed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            for at in range(0, len(texts), SLICE):
                yield pd.DataFrame([_analysed(t) for t in texts.iloc[at : at + SLICE]], columns=_ROW.names)

    rows = stored(df.select(F.col(id_col).alias("id"), analysed(F.col(text_col)).alias("r")).select("id", "r.*"), "pii")
    total = max(1, rows.count())
    near = rows.where(F.size("near") > 0).select("id", "hash", F.explode("near").alias("x")).select("id", "hash", "x.*")
    # copies of a context count once, and are folded before the terms are spread
    once = near.groupBy("entity", "context").agg(F.first("terms").alias("terms"))
    windows = once.select("entity", "context", F.explode(F.array_distinct("terms")).alias("term")).groupBy("entity", "term").agg(F.count("*").alias("windows"))
    windows = stored(windows.where(F.col("windows") >= SUPPORT), "pii-windows")
    # every text of an entity with its number of rows and one context
    texts = near.groupBy("entity", "hash", "id").agg(F.min("context").alias("context"))
    texts = stored(texts.groupBy("entity", "hash").agg(F.min("context").alias("context"), F.count("*").alias("n")), "pii-texts")
    holding = texts.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count_distinct("context").alias("contexts"))
    supported = holding.join(windows.select("entity", F.lit(True).alias("close")).distinct(), "entity", "left")
    supported = supported.where((F.col("contexts") >= SUPPORT) | F.col("close")).select("entity", "n_e").where(F.col("n_e") < total)
    texts = stored(texts.join(supported, "entity"), "pii-supported")
    words = rows.where(F.size("near") > 0).join(texts.select("hash").distinct(), "hash", "left_semi")
    words = stored(words.groupBy("hash").agg(F.first("words").alias("words")).select("hash", F.explode("words").alias("term")), "pii-words")
    terms = _document_counts(df, text_col, words.select("term").distinct()).withColumnRenamed("n", "n_t")
    n_e, n_t, n_et = (F.col(c).cast("double") for c in ("n_e", "n_t", "n_et"))
    least = threshold * F.log(total / n_e)
    # a pair stands together in no more documents than either alone: most words are too frequent and go before they are counted
    together = (
        words.join(stored(terms, "pii-terms"), "term")
        .join(texts, "hash")
        .where(F.log(total / F.greatest(n_e, n_t)) >= least - 1e-9)
        .groupBy("entity", "term", "n_e", "n_t")
        .agg(F.sum("n").alias("n_et"), F.count_distinct("context").alias("contexts"))
        .join(windows, ["entity", "term"], "left")
    )
    supported = (F.col("contexts") >= SUPPORT) | F.col("windows").isNotNull()
    telling = stored(together.where(supported & (F.log(n_et * total / (n_e * n_t)) >= least)).select("term").distinct(), "pii-telling")
    if telling.isEmpty():
        added = rows.select("hash", F.expr("cast(null as array<struct<start: bigint, end: bigint>>)").alias("added")).limit(0)
    else:
        added = _everywhere(df, text_col, telling)
    as_text = F.transform("added", lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["end"]))
    parts = F.concat(F.when(F.col("base") != "", F.array("base")).otherwise(F.array()), F.coalesce(as_text, F.array()))
    return rows.drop("near", "words").join(added, "hash", "left").select("id", "hash", *[f"n_{k}" for k in KINDS], "base", F.array_join(parts, ",").alias("spans"))


LABELS = {**{k: f"<{k}>" for k in KINDS}, "term": "<term>"}


def replaced(text: str | None, spans: str | None) -> str | None:
    """The text with a label in place of every span; overlapping spans are replaced as one, under the first one's label."""
    if not text or not spans:
        return text
    places = sorted((int(a), -int(b), k) for k, a, b in (s.split(":") for s in spans.split(",")))
    out, at = [], 0
    for a, b, kind in places:
        if a >= at:
            out += [text[at:a], LABELS[kind]]
        at = max(at, -b)
    return "".join([*out, text[at:]])


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`df` with all spans of its texts replaced by labels; other columns and the number of rows unchanged.

    A column named n_chars is not adjusted; null texts stay null.
    """

    @F.pandas_udf(T.StringType())
    def clean(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in batches:
            for at in range(0, len(texts), SLICE):
                pairs = zip(texts.iloc[at : at + SLICE], spans.iloc[at : at + SLICE], strict=True)
                yield pd.Series([replaced(t, s) for t, s in pairs], dtype=object)

    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    text = names[df.columns.index(text_col)]
    found = find(plain, names[df.columns.index(id_col)], text, threshold).where("spans <> ''")
    per_text = found.groupBy("hash").agg(F.first("spans").alias("spans"))

    @F.pandas_udf(T.LongType())
    def digest(texts: pd.Series) -> pd.Series:
        return pd.Series([xxhash.xxh64_intdigest((t or "").encode("utf-8", "replace")) - (1 << 63) for t in texts], dtype="int64")

    joined_rows = plain.withColumn("_hash", digest(F.col(text))).join(per_text.withColumnRenamed("hash", "_hash"), "_hash", "left")
    return joined_rows.select(*[clean(F.col(c), F.col("spans")).alias(c) if c == text else F.col(c) for c in names]).toDF(*df.columns)
