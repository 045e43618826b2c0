"""Periodic runs of words by maximal pairs on the LCP-interval tree.

A run of period q and length n is a maximal pair: the stretch of n - q words at its start stands again
q words on, the words to the left of both differ (or one has none), and so do those to the right. With
four periods to a run the pair's length is at least three times its distance. Suffixes of a document
that repeat LEAST_REPEAT words are ordered by prefix doubling; their LCP-interval tree is built bottom
up. A node of depth d holds the left-word classes of its suffixes as one list by position, the class of
an entry being the word before it. Where children meet, entries of different children and different
classes at a distance q with 3 q <= d are maximal pairs, and so runs, without any extension. By the
periodicity of the stretch, the entry at the smallest distance stands next to the other in the list, so
each entry of the smaller child looks at its two neighbours only.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 6
LEAST_PERIODS = 4
#: No run has a maximal pair shorter than this: length 6 at period 1, and three periods of any other.
LEAST_REPEAT = LEAST_LENGTH - 1
#: Words of so many texts are handled at once; a longer text is handled alone.
PART = 1 << 17
SLICE = 256
FOUND = "n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"
#: Changes the words of a document, given its id as text, before its runs are looked for.
Edit = Callable[[str | None, list[bytes]], list[bytes]]


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _repeated(words: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions whose LEAST_REPEAT words stand elsewhere in their document too; `ends` by position."""
    at = np.flatnonzero(np.arange(len(words)) + LEAST_REPEAT <= ends)
    # one word more at a time: what stands once in its document drops out before the next is compared
    group = doc[at]
    for step in range(LEAST_REPEAT):
        group = _ranks(group * (int(words.max(initial=0)) + 1) + words[at + step])
        alive = np.bincount(group)[group] > 1
        at, group = at[alive], group[alive]
        if not len(at):
            break
    return at


def _ordered(at: np.ndarray, words: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffixes in word order, those at `at` and those LEAST_REPEAT words on, and the ranks of each prefix length.

    A rank is the place of the first suffix with the same prefix; other suffixes have ranks of their own.
    """
    n = len(words)
    at = np.union1d(at, (at + LEAST_REPEAT)[at + LEAST_REPEAT < ends[at]])
    keys = [np.where(at + k < ends[at], words[np.minimum(at + k, n - 1)], -1) for k in range(LEAST_REPEAT)]
    order = np.lexsort((*keys[::-1], doc[at]))
    at = at[order]
    new = np.append(True, np.any([k[1:] != k[:-1] for k in [doc[at], *(k[order] for k in keys)]], axis=0))
    first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    rank = len(at) + np.arange(n + 1)
    rank[at] = first
    levels, length = [(LEAST_REPEAT, rank.copy())], LEAST_REPEAT
    place = at.copy()
    while True:
        sizes = np.bincount(first, minlength=len(at))
        open_ = np.flatnonzero(sizes[first] > 1)
        if not len(open_):
            return place, levels
        here = place[open_]
        beyond = here + length
        # at most one suffix of a group ends here: the end of its document is unlike any other rank
        second = np.where(beyond < ends[here], rank[np.minimum(beyond, n)], -1)
        sorted_ = np.lexsort((second, first[open_]))
        here, second, old = here[sorted_], second[sorted_], first[open_][sorted_]
        new = np.append(True, (old[1:] != old[:-1]) | (second[1:] != second[:-1]))
        place[open_] = here
        first[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        rank[here] = first[open_]
        length *= 2
        levels.append((length, rank.copy()))


def _common(a: np.ndarray, b: np.ndarray, words: np.ndarray, ends: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Words that the suffixes a and b of the same document share from their starts."""
    n, a, b, shared = len(words), a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
    end = ends[np.minimum(a, n - 1)]
    for length, rank in reversed(levels):
        same = (a < end) & (b < end) & (rank[np.minimum(a, n)] == rank[np.minimum(b, n)])
        for x in (a, b, shared):
            x[same] += length
    going = np.ones(len(a), dtype=bool)
    for _ in range(LEAST_REPEAT):
        going &= (a < end) & (b < end)
        going[going] = words[a[going]] == words[b[going]]
        for x in (a, b, shared):
            x[going] += 1
    return shared


def _meet(small: list[int], large: list[int], depth: int, left: list[int], found: dict) -> None:
    """Maximal pairs between two children of a node within the length constraints; the classes then stand in `large`."""
    limit, size = depth // (LEAST_PERIODS - 1), len(large)
    for position in small:
        k = bisect_left(large, position, 0, size)
        for j in (k - 1, k):
            if 0 <= j < size:
                other = large[j]
                start, period = (other, position - other) if other < position else (position, other - position)
                if period <= limit and depth + period >= LEAST_LENGTH and left[start] != left[start + period]:
                    key = (start, depth + period)
                    if found.get(key, period) >= period:
                        found[key] = period
    large.extend(small)
    large.sort()


def _tree(place: list[int], lcp: list[int], left: list[int]) -> dict[tuple[int, int], int]:
    """(start, length) -> smallest period of all runs; lcp[i] belongs to suffixes i - 1 and i, 0 between trees."""
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, list[int]]] = []
    for i in range(1, len(place) + 1):
        depth, child = lcp[i] if i < len(place) else 0, [place[i - 1]]
        while stack and stack[-1][0] >= depth:
            above, held = stack[-1]
            if above == 0:
                break
            if len(held) < len(child):
                held, child = child, held
            _meet(child, held, above, left, found)
            stack.pop()
            child = held
            if above == depth:
                break
        if depth:
            stack.append((depth, child))
    return found


def runs_of(texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each sequence of word numbers, by start, then period."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    words = np.concatenate([np.asarray(t, dtype=np.int64) for t in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes)
    begins, end_at = ends - sizes, ends[doc]
    at = _repeated(words, doc, end_at)
    if not len(at):
        return out
    place, levels = _ordered(at, words, doc, end_at)
    lcp = np.append(0, _common(place[:-1], place[1:], words, end_at, levels))
    lcp[1:][doc[place[1:]] != doc[place[:-1]]] = 0
    lcp[lcp < LEAST_REPEAT] = 0
    left = np.append(-1, words[:-1])
    left[begins[sizes > 0]] = -1
    for (start, length), period in _tree(place.tolist(), lcp.tolist(), left.tolist()).items():
        k = int(doc[start])
        out[k].append((start - int(begins[k]), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that stand in no run after its first period, joined by one space."""
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words).decode()


def _parts(batches: Iterator[tuple[pd.Series, pd.Series]], edit: Edit | None) -> Iterator[list[list[bytes]]]:
    """Words of the texts, some texts at a time, so that what a task holds follows neither batches nor one long text beside others."""
    for keys, texts in batches:
        part, size = [], 0
        for key, text in zip(keys, texts, strict=True):
            # of bytes, split() takes exactly the six ASCII blanks
            words = (text or "").encode().split()
            part.append(edit(key, words) if edit else words)
            size += len(words)
            if size >= PART or len(part) == SLICE:
                yield part
                part, size = [], 0
        if part:
            yield part


def _found(part: list[list[bytes]]) -> pd.DataFrame:
    numbers: dict[bytes, int] = {}
    found = runs_of([[numbers.setdefault(w, len(numbers)) for w in words] for words in part])
    columns = [[[r[i] for r in runs] for runs in found] for i in range(3)]
    return pd.DataFrame(
        {
            "n_words": [len(words) for words in part],
            **dict(zip(("starts", "lengths", "periods"), columns, strict=True)),
            "collapsed": [_collapsed(words, runs) for words, runs in zip(part, found, strict=True)],
        }
    )


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Edit | None = None) -> DataFrame:
    """One row per input row: id, n_words, runs (structs start, length, period, by start, then period), collapsed.

    Words are stretches without the six ASCII blanks, numbered from 0. A run has at least 6 words and
    four of its smallest periods and is extended by no neighbour. collapsed holds the words that no run
    contains after its first period, joined by one space. Null and empty texts have no word, no run and
    an empty collapsed text. Rows are independent (`edit` may change the words of each first): null and repeated ids stay, equal texts have equal
    results, texts of any length are handled whole, an empty table gives an empty result, and other
    columns are not read, whatever their names.
    """

    @F.pandas_udf(FOUND)
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from map(_found, _parts(batches, edit))

    rows = df.select(F.col(id_col).alias("id"), found(F.col(id_col).cast("string"), F.col(text_col)).alias("f"))
    runs = F.arrays_zip(F.col("f.starts").alias("start"), F.col("f.lengths").alias("length"), F.col("f.periods").alias("period"))
    return rows.select("id", "f.n_words", runs.alias("runs"), "f.collapsed")


def looped(key: str | None, words: list[bytes]) -> list[bytes]:
    """The words with a tail that repeats itself, in one of ten documents by the checksum of the decimal id; a null id changes nothing."""
    h, n = zlib.crc32((key or "").encode()), len(words)
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]
