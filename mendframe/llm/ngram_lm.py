"""Scores of texts under an n-gram model kept in Elias-Fano tries.

Tokens are the words of a text, A-Z lower-cased, and one end. A bigram is a token after its context
(the token before it in the text, the end for the first). With c the training counts, T(h) the
number of tokens seen after h, N all tokens and V distinct ones,

    p(w | h) = max(c(h, w) - D, 0) / c(h) + D T(h) / c(h) * p(w),   p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))

and p(w | h) = p(w) after a context that was not seen in training.

Texts are gathered into blocks of about BLOCK tokens, coded by word number and stored once. A block
sends every shard of the model its distinct bigrams with their training counts; a shard is a range
of context hashes. The shard merges what all blocks send into a trie of two levels: the contexts, and
behind a monotone pointer sequence the tokens after each, all Elias-Fano coded, with quantised
discounted log probabilities. The levels go to files that are mapped into memory, answer the shard's
blocks by searches relative to the context, and go with the task. The answers, one byte a bigram,
return to the blocks, which add up their texts. Counts that scores rest on exactly (c(w), N, V) come
with the contexts.

The number of shards grows with the tokens, so a shard stays of one size. Contexts with over 1/HOT of
all tokens (at most HOT of them), if large for a shard, are dealt over several by the following token.
Nothing passes through the driver but totals and the statistics of these contexts.
"""

from __future__ import annotations

import math
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendframe.llm.common import stored

DISCOUNT = 0.75
BLOCK = 1 << 19
SHARD = 1 << 19
HOT = 1 << 16
WORD_BITS = 48
CHUNK = 1 << 15
END = xxhash.xxh64_intdigest(b"")


# --- Elias-Fano levels -----------------------------------------------------------------------


class EliasFano:
    """A monotone sequence of unsigned integers: high parts as a unary bit vector, low parts as whole bytes.

    The low part is rounded up to bytes, so that a stretch of it is read without shifting bits. `parts`
    are the arrays to store; they may be memory-mapped.
    """

    def __init__(self, size: int, low_bytes: int, low: np.ndarray, high: np.ndarray, select: np.ndarray):
        self.size, self.low_bytes, self.low, self.high, self.select = size, low_bytes, low, high, select

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, low_bytes: int) -> EliasFano:
        """From the high parts (monotone) and the low parts, low_bytes bytes each."""
        ones = high.astype(np.int64) + np.arange(len(high))
        bits = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, dtype=np.uint8)
        bits[ones] = 1
        raw = low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :low_bytes]
        # the place of every CHUNK-th element's bit, to enter the vector near any element
        return cls(len(high), low_bytes, np.ascontiguousarray(raw).ravel(), np.packbits(bits), ones[::CHUNK].astype("<i8"))

    @classmethod
    def of(cls, values: np.ndarray, universe_bits: int) -> EliasFano:
        """From values below 2^universe_bits."""
        wanted = max(0, universe_bits - int(math.log2(len(values)))) if len(values) else 0
        low_bytes = min(7, (wanted + 7) // 8)
        mask, shift = np.uint64((1 << 8 * low_bytes) - 1), np.uint64(8 * low_bytes)
        values = values.astype(np.uint64)
        return cls.build((values >> shift).astype(np.int64), values & mask, low_bytes)

    def parts(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """(high parts, low parts) of the elements from start to stop."""
        if stop <= start:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        first = int(self.select[start // CHUNK])
        enough = int(self.select[(stop - 1) // CHUNK + 1]) + 1 if (stop - 1) // CHUNK + 1 < len(self.select) else len(self.high) * 8
        bits = np.unpackbits(np.asarray(self.high[first // 8 : (enough + 7) // 8]))
        ones = np.flatnonzero(bits[first % 8 :]) + first
        at = start - start // CHUNK * CHUNK
        high = ones[at : at + stop - start] - np.arange(start, stop)
        low = np.zeros((stop - start, 8), dtype=np.uint8)
        low[:, : self.low_bytes] = np.asarray(self.low[start * self.low_bytes : stop * self.low_bytes]).reshape(stop - start, self.low_bytes)
        return high, low.view("<u8").ravel()

    def values(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        high, low = self.parts(start, self.size if stop is None else stop)
        return (high.astype(np.uint64) << np.uint64(8 * self.low_bytes)) | low if self.low_bytes < 8 else low

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of sorted values in the sequence, -1 where absent."""
        out = np.full(len(wanted), -1, dtype=np.int64)
        done = 0
        for start in range(0, self.size, CHUNK):
            here = self.values(start, min(self.size, start + CHUNK))
            stop = len(wanted) if start + CHUNK >= self.size else int(np.searchsorted(wanted, here[-1], "right"))
            at = np.minimum(np.searchsorted(here, wanted[done:stop]), len(here) - 1)
            out[done:stop] = np.where(here[at] == wanted[done:stop], start + at, -1)
            done = stop
        return out


class Trie:
    """Contexts, pointers, the tokens after each context, and a one-byte code of each log probability."""

    FILES = ("context", "pointer", "token")

    def __init__(self, context: EliasFano, pointer: EliasFano, token: EliasFano, codes: np.ndarray, scale: tuple[float, float]):
        self.context, self.pointer, self.token, self.codes, self.scale = context, pointer, token, codes, scale

    @classmethod
    def build(cls, contexts: np.ndarray, starts: np.ndarray, tokens: np.ndarray, log_p: np.ndarray) -> Trie:
        """contexts: sorted; starts: first successor of each, and the end; tokens: sorted within a context."""
        owner = np.repeat(np.arange(len(contexts)), np.diff(starts))
        low, step = (float(log_p.min()), max(1e-9, float(np.ptp(log_p)) / 254)) if len(log_p) else (0.0, 1.0)
        return cls(
            EliasFano.of(contexts, 64),
            EliasFano.of(starts, max(1, int(starts[-1]).bit_length())),
            EliasFano.build(owner, tokens.astype(np.uint64), WORD_BITS // 8),
            (1 + np.rint((log_p - low) / step)).astype(np.uint8),
            (low, step),
        )

    def mapped(self, folder: str) -> Trie:
        """The same trie over files in `folder`, mapped into memory."""

        def on_disk(name: str, array: np.ndarray) -> np.ndarray:
            path = os.path.join(folder, name)
            array.tofile(path)
            return np.memmap(path, dtype=array.dtype, mode="r") if array.size else array

        levels = {}
        for name in self.FILES:
            level = getattr(self, name)
            levels[name] = EliasFano(level.size, level.low_bytes, *(on_disk(f"{name}-{part}", getattr(level, part)) for part in ("low", "high", "select")))
        return Trie(**levels, codes=on_disk("codes", self.codes), scale=self.scale)

    def successors(self, at: np.ndarray) -> np.ndarray:
        """Number of tokens after the contexts at these places (-1: none)."""
        counts = np.append(np.diff(self.pointer.values().astype(np.int64)), 0)
        return counts[at]

    def lookup(self, at: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Codes of bigrams, 0 where absent; `at`: ascending places of their contexts, tokens ascending within one."""
        out = np.zeros(len(at), dtype=np.uint8)
        pointer = self.pointer.values().astype(np.int64)
        for first in range(0, self.context.size, CHUNK):
            last = min(self.context.size, first + CHUNK)
            a, b = np.searchsorted(at, [first, last])
            if a == b:
                continue
            high, low = self.token.parts(int(pointer[first]), int(pointer[last]))
            # within the stretch the context's number stands above the token: one search finds all
            here = ((high - first).astype(np.uint64) << np.uint64(WORD_BITS)) | low
            wanted = ((at[a:b] - first).astype(np.uint64) << np.uint64(WORD_BITS)) | tokens[a:b]
            place = np.minimum(np.searchsorted(here, wanted), len(here) - 1)
            codes = np.asarray(self.codes[pointer[first] : pointer[last]])
            out[a:b] = np.where(here[place] == wanted, codes[place], 0)
        return out


# --- blocks ----------------------------------------------------------------------------------


def packed(array: np.ndarray) -> bytes:
    """Compressed, the bytes of equal place together."""
    array = np.ascontiguousarray(array)
    return zstandard.compress(np.ascontiguousarray(array.view(np.uint8).reshape(len(array), array.itemsize).T).tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (id, text, held) as coded blocks."""
    part, made = TaskContext.get().partitionId(), 0
    numbers: dict[bytes, int] = {b"": 0}
    docs, held, sizes, coded, total = [], [], [], [], 0

    def block() -> pd.DataFrame:
        nonlocal made
        tokens = np.concatenate(coded)
        rank = np.empty(len(numbers), dtype=np.int64)
        order = np.argsort(-np.bincount(tokens, minlength=len(numbers)), kind="stable")
        rank[order] = np.arange(len(order))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))[order]
        made += 1
        return pd.DataFrame(
            {
                "block": [part << 24 | made],
                "n": [len(tokens)],
                "docs": [docs],
                "held": [held],
                "sizes": [sizes],
                "hashes": [packed(hashes)],
                "tokens": [packed(rank[tokens].astype("<u4"))],
            }
        )

    for batch in batches:
        for doc, text, out in zip(batch["id"], batch["text"], batch["held"], strict=True):
            words = (text or "").encode().lower().split()
            words.append(b"")
            coded.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64))
            docs.append(doc)
            held.append(bool(out))
            sizes.append(len(words))
            total += len(words)
            if total >= BLOCK:
                yield block()
                numbers, docs, held, sizes, coded, total = {b"": 0}, [], [], [], [], 0
    if docs:
        yield block()


class Bigrams:
    """The distinct bigrams of a block in the order in which they travel: by shard, context hash, token hash."""

    def __init__(self, row, shards: int, hot: dict[str, np.ndarray]):
        self.hashes = unpacked(row["hashes"], "<u8")
        self.tokens = unpacked(row["tokens"], "<u4").astype(np.int64)
        self.sizes = np.asarray(row["sizes"], dtype=np.int64)
        self.held = np.repeat(np.asarray(row["held"], dtype=bool), self.sizes)
        end = int(np.flatnonzero(self.hashes == np.uint64(END))[0])
        before = np.concatenate([[end], self.tokens[:-1]])
        order = np.argsort(self.hashes, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        shard = ((self.hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        spread = np.ones(len(self.hashes), dtype=np.int64)
        if len(hot["hash"]):
            at = np.minimum(np.searchsorted(hot["hash"], self.hashes), len(hot["hash"]) - 1)
            spread = np.where(hot["hash"][at] == self.hashes, hot["spread"][at], 1)
        salt = (self.hashes[self.tokens] & np.uint64(0xFFFFFF)).astype(np.int64)
        where = (shard[before] + salt % spread[before]) % shards
        size = len(self.hashes)
        key = (where * size + rank[before]) * size + rank[self.tokens]
        unique, self.of_token = np.unique(key, return_inverse=True)
        self.counts = np.bincount(self.of_token[~self.held], minlength=len(unique))
        self.token, rest = order[unique % size], unique // size
        self.context, self.shard = order[rest % size], rest // size
        self.bounds = np.flatnonzero(np.concatenate([[True], self.shard[1:] != self.shard[:-1], [True]]))

    def slices(self) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
        """(shard, start, stop, first bigram of each context, number of its bigrams) of every shard met."""
        for start, stop in zip(self.bounds[:-1], self.bounds[1:], strict=True):
            context = self.context[start:stop]
            first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
            yield int(self.shard[start]), start, stop, first + start, np.diff(np.append(first, stop - start))


def _six_bytes(hashes: np.ndarray) -> np.ndarray:
    return hashes & np.uint64((1 << WORD_BITS) - 1)


def _messages(shards: int, hot):
    def messages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                pairs, out = Bigrams(row, shards, hot.value), []
                for shard, start, stop, first, number in pairs.slices():
                    words = _six_bytes(pairs.hashes[pairs.token[start:stop]])
                    raw = words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : WORD_BITS // 8]
                    out.append(
                        {
                            "shard": shard,
                            "block": row["block"],
                            "contexts": packed(pairs.hashes[pairs.context[first]]),
                            "numbers": packed(number.astype("<u4")),
                            "words": np.ascontiguousarray(raw).tobytes(),
                            "counts": packed(pairs.counts[start:stop].astype("<u4")),
                        }
                    )
                yield pd.DataFrame(out)

    return messages


_REPLY = "shard long, block long, contexts binary, after binary, codes binary, low double, step double, tokens long, types long, hot array<struct<hash:long,after:long>>"


def _answers(hot):
    def answers(frame: pd.DataFrame) -> pd.DataFrame:
        contexts = [unpacked(x, "<u8") for x in frame["contexts"]]
        numbers = [unpacked(x, "<u4").astype(np.int64) for x in frame["numbers"]]
        sent = [int(n.sum()) for n in numbers]
        raw = np.frombuffer(b"".join(frame["words"]), np.uint8).reshape(-1, WORD_BITS // 8)
        words = np.zeros((len(raw), 8), dtype=np.uint8)
        words[:, : WORD_BITS // 8] = raw
        words = words.view("<u8").ravel()
        counts = np.concatenate([unpacked(x, "<u4") for x in frame["counts"]]).astype(np.int64)
        known, context = np.unique(np.concatenate(contexts), return_inverse=True)
        owner = np.repeat(context, np.concatenate(numbers))
        distinct, word = np.unique(words, return_inverse=True)
        pairs, of_pair = np.unique(owner * len(distinct) + word, return_inverse=True)
        total = np.bincount(of_pair, weights=counts).astype(np.int64)
        owner, word = pairs // len(distinct), distinct[pairs % len(distinct)]
        in_context = np.bincount(owner, weights=total, minlength=len(known)).astype(np.int64)

        # the model of this shard: what training texts hold
        denominators, is_hot = in_context.copy(), np.zeros(len(known), dtype=bool)
        if len(hot.value["hash"]):
            at = np.minimum(np.searchsorted(hot.value["hash"], known), len(hot.value["hash"]) - 1)
            is_hot = hot.value["hash"][at] == known
            denominators = np.where(is_hot, hot.value["count"][at], denominators)
        seen = total > 0
        has = np.flatnonzero(in_context > 0)
        starts = np.concatenate([[0], np.cumsum(np.bincount(owner[seen], minlength=len(known))[has])]).astype(np.int64)
        log_p = np.log10((total[seen] - DISCOUNT) / denominators[owner[seen]])
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie.build(known[has], starts, word[seen], log_p).mapped(folder)
            place = trie.context.find(known)
            after = trie.successors(place)
            codes = np.zeros(len(pairs), dtype=np.uint8)
            inside = place[owner] >= 0
            codes[inside] = trie.lookup(place[owner[inside]], word[inside])
            low, step = trie.scale
            del trie
        out, c0, p0 = [], 0, 0
        for i, block in enumerate(frame["block"]):
            c1, p1 = c0 + len(contexts[i]), p0 + sent[i]
            mine = context[c0:c1]
            out.append((block, packed(in_context[mine].astype("<i8")), packed(after[mine].astype("<i8")), packed(codes[of_pair[p0:p1]]), low, step, 0, 0, []))
            c0, p0 = c1, p1
        spread = [{"hash": int(h), "after": int(n)} for h, n in zip(known[is_hot].view(np.int64), after[is_hot], strict=True)]
        out.append((-1, b"", b"", b"", low, step, int(total.sum()), int(((in_context > 0) & ~is_hot).sum()), spread))
        names = ["block", "contexts", "after", "codes", "low", "step", "tokens", "types", "hot"]
        return pd.DataFrame(out, columns=names).assign(shard=int(frame["shard"].iloc[0]))[["shard", *names]]

    return answers


def _scores(shards: int, hot, stats: dict[str, float]):
    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_tokens, types = stats["tokens"], stats["types"]
        for batch in batches:
            for _, row in batch.iterrows():
                pairs = Bigrams(row, shards, hot.value)
                count = np.zeros(len(pairs.hashes), dtype=np.int64)
                after, seen = count.copy(), np.zeros(len(pairs.token))
                replies = {r["shard"]: r for r in row["replies"]}
                for shard, start, stop, first, _ in pairs.slices():
                    reply, context = replies[shard], pairs.context[first]
                    count[context] = unpacked(reply["contexts"], "<i8")
                    after[context] = unpacked(reply["after"], "<i8")
                    codes = unpacked(reply["codes"], "<u1").astype(np.float64)
                    seen[start:stop] = np.where(codes > 0, 10 ** (reply["low"] + (codes - 1) * reply["step"]), 0.0)
                if len(hot.value["hash"]):
                    at = np.minimum(np.searchsorted(hot.value["hash"], pairs.hashes), len(hot.value["hash"]) - 1)
                    is_hot = hot.value["hash"][at] == pairs.hashes
                    count = np.where(is_hot, hot.value["count"][at], count)
                    after = np.where(is_hot, hot.value["after"][at], after)
                single = (count + 0.5) / (all_tokens + 0.5 * (types + 1))
                rest = np.where(count > 0, DISCOUNT * after / np.maximum(count, 1), 1.0)
                p = seen + rest[pairs.context] * single[pairs.token]
                starts = np.concatenate([[0], np.cumsum(pairs.sizes)[:-1]])
                yield pd.DataFrame(
                    {
                        "id": list(row["docs"]),
                        "held_out": np.asarray(row["held"], dtype=bool),
                        "n_tokens": pairs.sizes,
                        "n_known": np.add.reduceat((count > 0)[pairs.tokens].astype(np.int64), starts),
                        "base_score": np.add.reduceat(np.log10(single)[pairs.tokens], starts),
                        "score": np.add.reduceat(np.log10(p)[pairs.of_token], starts),
                    }
                )

    return scores


def _hot_contexts(blocks: DataFrame, tokens: int) -> dict[str, np.ndarray]:
    """hash, count in training texts and number of shards of the contexts too large for one shard, by hash."""
    least = max(SHARD / 4, tokens / HOT)

    def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                hashes, coded = unpacked(row["hashes"], "<u8"), unpacked(row["tokens"], "<u4")
                # tokens stand by falling frequency: those with a fourth of the share that makes a context hot
                counts = np.bincount(coded, minlength=len(hashes))
                top = counts >= least / tokens / 4 * len(coded)
                held = np.repeat(np.asarray(row["held"], dtype=bool), np.asarray(row["sizes"], dtype=np.int64))
                train = np.bincount(coded[~held], minlength=len(hashes))
                yield pd.DataFrame({"hash": hashes[top].view(np.int64), "n": counts[top], "t": train[top]})

    def counted(frame: DataFrame) -> list:
        total = frame.groupBy("hash").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
        return total.where(F.col("n") >= least / 2).collect()

    names = counted(blocks.mapInPandas(shares, "hash long, n long, t long"))
    wanted = np.sort(np.array([r["hash"] for r in names], dtype=np.int64).view(np.uint64))
    if not len(wanted):
        return {"hash": wanted, "count": np.empty(0, np.int64), "spread": np.empty(0, np.int64)}
    shared = blocks.sparkSession.sparkContext.broadcast(wanted)

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                hashes, coded = unpacked(row["hashes"], "<u8"), unpacked(row["tokens"], "<u4")
                at = np.flatnonzero(np.isin(hashes, shared.value))
                held = np.repeat(np.asarray(row["held"], dtype=bool), np.asarray(row["sizes"], dtype=np.int64))
                counts, train = (np.bincount(x, minlength=len(hashes))[at] for x in (coded, coded[~held]))
                yield pd.DataFrame({"hash": hashes[at].view(np.int64), "n": counts, "t": train})

    rows = blocks.mapInPandas(exact, "hash long, n long, t long").groupBy("hash").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).collect()
    rows = sorted(((np.int64(r["hash"]).view(np.uint64), r["t"], math.ceil(r["n"] / (SHARD / 4))) for r in rows), key=lambda r: r[0])
    return {
        "hash": np.array([r[0] for r in rows], dtype=np.uint64),
        "count": np.array([r[1] for r in rows], dtype=np.int64),
        "spread": np.array([r[2] for r in rows], dtype=np.int64),
    }


def score(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Rows where `held_out` is true are scored and not learned from; null counts as false. Null and empty
    texts have the end as their one token. Null and repeated ids are rows like others. An empty table
    gives an empty result. n_known counts tokens met in training; base_score takes p(w) for every token.
    Without training texts every token has the same probability. Whole texts are read; columns other
    than those named are not.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    schema = "block long, n long, docs array<string>, held array<boolean>, sizes array<int>, hashes binary, tokens binary"
    blocks = stored(rows.mapInPandas(_blocks, schema), "lm-blocks")
    tokens = blocks.agg(F.sum("n")).first()[0] or 0
    shards = max(1, math.ceil(tokens / SHARD))
    found = _hot_contexts(blocks, max(1, tokens)) if tokens else {k: np.empty(0, np.int64) for k in ("hash", "count", "spread")}
    hot = spark.sparkContext.broadcast(found)
    sent = blocks.mapInPandas(_messages(shards, hot), "shard long, block long, contexts binary, numbers binary, words binary, counts binary")
    # a group is one shard; its blobs are bounded by the number of shards
    replies = stored(sent.groupBy("shard").applyInPandas(_answers(hot), _REPLY), "lm-answers")
    totals = replies.where("block = -1")
    sums = totals.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    after = {r["hash"]: r["after"] for r in totals.select(F.explode("hot").alias("h")).select("h.*").groupBy("hash").agg(F.sum("after").alias("after")).collect()}
    found = {**found, "after": np.array([after.get(int(h), 0) for h in found["hash"].view(np.int64)], dtype=np.int64)}
    stats = {"tokens": sums["tokens"] or 0, "types": (sums["types"] or 0) + int((found["count"] > 0).sum())}
    by_block = replies.where("block >= 0").groupBy("block").agg(
        F.collect_list(F.struct("shard", "contexts", "after", "codes", "low", "step")).alias("replies")
    )
    scored = blocks.join(by_block, "block").mapInPandas(
        _scores(shards, spark.sparkContext.broadcast(found), stats),
        "id string, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.withColumns({"id": F.col("id").cast("long"), "train_tokens": F.lit(stats["tokens"]).cast("long")})


def every_fifth(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1
