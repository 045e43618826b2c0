"""BPE encoding and decoding with batched numpy merge rounds.

The words of a batch that were not met before stand one after the other in a flat array of symbols.
A round looks up the rank of every neighbouring pair of the same word by binary search in the sorted
pair keys, finds the lowest rank of each word, and merges all its occurrences from left to right; a
word leaves the rounds when none of its pairs has a rank. Words keep their ids between batches in a
table of bounded size.

The vocabulary file is a parameter and is read on the driver; its merges travel to the tasks as
arrays of the vocabulary's fixed size. Supported are files of the `tokenizers` library with a BPE
model over byte symbols, an end-of-word suffix, NFC and lower-casing before, a split pattern whose
matches are kept, special tokens found in the raw text, and no decoder (tokens joined by blanks).
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_CACHE = 1 << 17
PART = 1 << 16
SLICE = 256


@cache
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in names:
            names[b] = chr(extra)
            extra += 1
    return [names[b] for b in range(256)]


class Vocabulary:
    """Arrays of a vocabulary: ids of bytes and end bytes, sorted pair keys with ranks and results, token texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, ids = spec["model"], spec["model"]["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or spec.get("decoder"):
            raise ValueError("this kind of vocabulary file is not supported")
        self.pattern = split["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for text, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = text
        symbols = byte_symbols()
        self.middle = np.array([ids[s] for s in symbols], dtype=np.int64)
        self.last = np.array([ids[s + suffix] for s in symbols], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = len(self.tokens)
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], dtype=np.int64)
        # a pair that is listed twice keeps its later rank, as in a map filled in order
        keys, first = np.unique(keys[::-1], return_index=True)
        self.keys, self.ranks = keys, len(pairs) - 1 - first
        results = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        self.results = results[self.ranks]


def merge_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, number of ids of each word); no word may be empty."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    symbols = vocabulary.middle[data]
    ends = np.cumsum(sizes) - 1
    symbols[ends] = vocabulary.last[data[ends]]
    word = np.repeat(np.arange(len(words)), sizes)
    done_symbols, done_words = [], []
    none = len(vocabulary.ranks) + 1
    while len(symbols):
        key = symbols[:-1] * vocabulary.size + symbols[1:]
        at = np.minimum(np.searchsorted(vocabulary.keys, key), len(vocabulary.keys) - 1)
        found = (vocabulary.keys[at] == key) & (word[:-1] == word[1:])
        rank = np.append(np.where(found, vocabulary.ranks[at], none), none)
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(word))))
        open_ = lowest < none
        if not open_.all():
            done_symbols.append(symbols[~open_])
            done_words.append(word[~open_])
        hit = open_ & (rank == lowest)
        # of overlapping hits (a a a) the first, third, ... of a run are merged
        run = np.flatnonzero(hit & ~np.append(False, hit[:-1] & (word[:-1] == word[1:])))
        position = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit)))) if len(run) and run[0] == 0 else _since(run, len(hit))
        hit &= position % 2 == 0
        where = np.flatnonzero(hit)
        symbols[where] = vocabulary.results[at[where]]
        open_[where + 1] = False
        symbols, word = symbols[open_], word[open_]
    if not done_symbols:
        return np.empty(0, np.int64), np.zeros(len(words), np.int64)
    all_symbols, all_words = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(all_words, kind="stable")
    return all_symbols[order], np.bincount(all_words, minlength=len(words))


def _since(run: np.ndarray, size: int) -> np.ndarray:
    """Distance of every position from the last run start at or before it."""
    marks = np.zeros(size, dtype=np.int64)
    marks[run] = run
    return np.arange(size) - np.maximum.accumulate(marks)


class Encoder:
    """Encodes texts; keeps the ids of at most WORD_CACHE words between texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = regex.compile(vocabulary.pattern)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.known: dict[str, int] = {}
        self.ids, self.starts = np.empty(0, np.int64), np.zeros(1, np.int64)

    def _learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.known]
        if not fresh:
            return
        if len(self.known) + len(fresh) > WORD_CACHE and self.known:
            self.known, self.ids, self.starts = {}, np.empty(0, np.int64), np.zeros(1, np.int64)
            fresh = sorted(words)
        ids, sizes = merge_words([w.encode() for w in fresh], self.vocabulary)
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def split(self, text: str) -> tuple[list, bool]:
        """The words of a text in order, a special token as its id; whether there is such a token."""
        parts = self.special.split(text) if self.special else [text]
        if len(parts) == 1:
            return self._plain(text), False
        out: list = []
        for i, part in enumerate(parts):
            out += [self.vocabulary.special[part]] if i % 2 else self._plain(part)
        return out, True

    def _plain(self, text: str) -> list[str]:
        # lower-casing goes by single characters: the word-final form of sigma is not used
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, batch, size = [], [], 0
        for text in texts:
            batch.append(self.split(text))
            size += len(batch[-1][0])
            if size >= PART:
                out += self._encode(batch)
                batch, size = [], 0
        return out + self._encode(batch)

    def _encode(self, batch: list[tuple[list, bool]]) -> list[np.ndarray]:
        unique: set = set()
        unique.update(*(words for words, _ in batch))
        self._learn(unique - set(self.vocabulary.special.values()))
        known, out = self.known, []
        for words, special in batch:
            if special:
                parts = [[w] if type(w) is int else self.ids[self.starts[known[w]] : self.starts[known[w] + 1]] for w in words]
                out.append(np.concatenate(parts).astype("<u4"))
                continue
            at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            first, size = self.starts[at], self.starts[at + 1] - self.starts[at]
            ends = np.cumsum(size)
            offset = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
            out.append(self.ids[np.repeat(first, size) + offset].astype("<u4"))
        return out


def _slices(batches: Iterator[pd.Series]) -> Iterator[list]:
    """Values of Arrow batches, a few rows at a time, so that what a task holds does not follow the batch size."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.iloc[at : at + SLICE].tolist()


def _decoded(tokens: np.ndarray, ids: bytes | None) -> str:
    array = np.frombuffer(ids or b"", "<u4")
    return " ".join(tokens[array[array < len(tokens)]].tolist())


def encode(df: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """`df` with `out_col`: the ids of the whole text as bytes, four a token, little-endian unsigned.

    Nulls and empty texts give no bytes. Rows are independent: repeated rows and ties get equal ids,
    an empty table stays empty, other columns pass unchanged. An existing `out_col` is replaced.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))

    @F.pandas_udf(T.BinaryType())
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary.value)
        for texts in _slices(batches):
            yield pd.Series([x.tobytes() for x in encoder.encode([t or "" for t in texts])], dtype=object)

    return df.withColumn(out_col, ids(F.col(text_col)))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`df` with `out_col`: the texts of the tokens, special ones included, joined by blanks.

    Null ids decode as none, to the empty text; ids outside the vocabulary are left out.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))

    @F.pandas_udf(T.StringType())
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = np.array(vocabulary.value.tokens, dtype=object)
        for batch in _slices(batches):
            yield pd.Series([_decoded(tokens, b) for b in batch], dtype=object)

    return df.withColumn(out_col, texts(F.col(ids_col)))


def encode_decode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """`df` with ids and decoded, as `decode(encode(df))` gives them, in one pass through one Python worker a task."""
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))

    @F.pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, tokens = Encoder(vocabulary.value), np.array(vocabulary.value.tokens, dtype=object)
        for texts in _slices(batches):
            ids = [x.tobytes() for x in encoder.encode([t or "" for t in texts])]
            yield pd.DataFrame({"ids": ids, "decoded": [_decoded(tokens, b) for b in ids]}, dtype=object)

    kept = [c for c in df.columns if c not in ("ids", "decoded")]
    names = [f"c{i}" for i in range(len(kept))]
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)], both(F.col(text_col)).alias("_both"))
    return rows.select(*names, "_both.ids", "_both.decoded").toDF(*kept, "ids", "decoded")
