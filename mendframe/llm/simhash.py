"""SimHash near-duplicates by covering locality-sensitive hashing.

Every pair of fingerprints that differs in at most RADIUS bits shares all kept bits of at least one
mask: bit i carries a nonzero vector m(i) of RADIUS + 1 bits, and mask v keeps the bits with
<m(i), v> = 1 over GF(2). For RADIUS differing bits there is a nonzero v orthogonal to all their
vectors. Nothing is missed, so there is no recall to measure.

Copies are folded first: only distinct fingerprints enter the tables. A bucket of two gives its pair
from one aggregate; a small bucket is compared in one task and gives a spanning star, never all
pairs; a larger bucket is hashed again by the next level's masks on the bits it has left. After the
last level so few bits are left that a bucket cannot exceed the bound (`most_left`).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.llm.common import components, key_or_last, last_as_null, stored

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
LEVELS = 4
BUCKET = 512
CHUNK = 1 << 16


def masks(level: int, radius: int = RADIUS) -> list[int]:
    """The 2^(radius+1) - 1 masks of a level; levels deal the vectors to the bits in different orders."""
    tables = 2 ** (radius + 1) - 1
    vector = np.empty(BITS, dtype=np.int64)
    vector[np.random.default_rng(100 + level).permutation(BITS)] = np.arange(BITS) % tables + 1
    return [sum(1 << i for i in range(BITS) if int(vector[i] & v).bit_count() % 2) for v in range(1, tables + 1)]


def most_left(levels: int = LEVELS, radius: int = RADIUS) -> int:
    """The most bits that any chain of masks leaves free: a last bucket has at most 2 to that power rows."""
    chains = {0}
    for level in range(levels):
        chains = {kept | mask for kept, mask in product(chains, masks(level, radius))}
    return BITS - min(kept.bit_count() for kept in chains)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of a text; 0 where there is no word. Works through CHUNK shingles at a time."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    digest, total, counts = xxhash.xxh64_intdigest, len(words) - size + 1, np.zeros(BITS, dtype=np.int64)
    for at in range(0, total, CHUNK):
        stop = min(total, at + CHUNK)
        spans = zip(starts[at:stop].tolist(), ends[at + size - 1 : stop + size - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, stop - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return _signed(int.from_bytes(np.packbits(counts * 2 > total, bitorder="little").tobytes(), "little"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of every whole text as a signed long."""

    @F.pandas_udf(T.LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return df.select(F.col(id_col).cast("long").alias("id"), simhash(F.col(text_col)).alias("fp"))


def bucket_stars(codes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links from every member of a connected part of a bucket to its smallest member."""
    codes = np.unique(codes)
    near = np.bitwise_count((codes[:, None] ^ codes[None, :]).view(np.uint64)) <= radius
    labels = np.arange(len(codes))
    while True:
        lower = np.where(near, labels[None, :], len(codes)).min(axis=1)
        if (lower == labels).all():
            break
        labels = lower
    moved = np.flatnonzero(labels != np.arange(len(codes)))
    return list(zip(codes[moved].tolist(), codes[labels[moved]].tolist(), strict=True))


def near_links(codes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, levels: int = LEVELS) -> DataFrame:
    """Links (a, b) that connect all distinct codes (column fp, long) within `radius` bits of each other."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [pair for codes in batch["codes"] for pair in bucket_stars(np.asarray(codes, np.int64), radius)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    rows = codes.select("fp", F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("kept"))
    tables, links = 2 ** (radius + 1) - 1, []
    for level in range(levels):
        table = F.array(
            *[F.struct(F.lit(t).cast("long").alias("t"), F.lit(_signed(m)).alias("m")) for t, m in enumerate(masks(level, radius))]
        )
        keyed = (
            rows.withColumn("x", F.explode(table))
            .withColumn("kept", F.col("kept").bitwiseOR(F.col("x.m")))
            .select("fp", (F.col("path") * tables + F.col("x.t")).alias("path"), "kept", F.col("fp").bitwiseAND(F.col("kept")).alias("key"))
        )
        sizes = stored(
            keyed.groupBy("path", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"),
            "buckets",
        )
        last = level == levels - 1
        links.append(
            sizes.where((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
        )
        many = F.col("n") > 2 if last else F.col("n").between(3, bucket)
        links.append(
            keyed.join(sizes.where(many).select("path", "key"), ["path", "key"])
            .groupBy("path", "key")
            .agg(F.collect_list("fp").alias("codes"))
            .select("codes")
            .mapInPandas(compare, "a long, b long")
        )
        if last or sizes.where(F.col("n") > bucket).isEmpty():
            break
        rows = keyed.join(sizes.where(F.col("n") > bucket).select("path", "key"), ["path", "key"]).select("fp", "path", "kept")
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found


def _grouped(prints: DataFrame, radius: int) -> DataFrame:
    """`prints` (id, fp, any others; stored) with component and root, the group's smallest id and its own fingerprint."""
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "codes")
    linked = components(near_links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    # only linked fingerprints need their group's smallest id; stored, so that the joins know how few they are
    linked = stored(linked.join(distinct, "fp"), "simhash-linked")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component"))
    grouped = stored(linked.join(smallest, "root").select("fp", "root", "component"), "simhash-groups")
    labels = distinct.join(grouped, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "first").alias("component")
    )
    return prints.join(labels, "fp")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component (smallest id reachable by links).

    Texts are lower-cased in A-Z and cut at ASCII white space; shingles count with their repeats; a
    fingerprint bit is set where over half of the shingle hashes have it. Null and empty texts have
    fingerprint zero and link like any other. A null id counts as the largest one, so it never
    stands for others; the component is null only where all its ids are. Repeated ids are separate
    rows. An empty table gives an empty result. Columns other than the two named are not read.
    """
    prints = stored(fingerprints(df, id_col, text_col, shingle).withColumn("id", key_or_last(F.col("id"))), "simhash")
    return _grouped(prints, radius).select(
        last_as_null(F.col("id")).alias("id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        last_as_null(F.col("component")).alias("component"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of `df` whose id is the smallest of its group: one row a group, all columns unchanged.

    Rows that repeat an id stay only once (the one whose text hashes lowest).
    """
    names = [f"_c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    at, text = names[df.columns.index(id_col)], names[df.columns.index(text_col)]
    groups = near_duplicates(plain, at, text, shingle, radius)
    ours = groups.select(key_or_last(F.col("id")).alias("_key"), key_or_last(F.col("component")).alias("_root"))
    winners = ours.where(F.col("_key") == F.col("_root")).select("_key").distinct()
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(text)))
    kept = plain.withColumn("_key", key_or_last(F.col(at))).join(winners, "_key", "left_semi")
    return kept.withColumn("_rank", rank).where("_rank = 1").select(*names).toDF(*df.columns)


def keep_one_row(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of `df` for each group of near-duplicate texts, whatever the ids; all columns unchanged.

    Rows are told apart by id and text, so different texts that share an id, or have none, stay as long as
    their groups differ. Of a group the row with the smallest id stays (null last), then the one whose text
    hashes lowest; of rows equal in both any one, as the hash of their other columns has it.
    """
    names = [f"_c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    at, text = names[df.columns.index(id_col)], names[df.columns.index(text_col)]
    marks = [F.xxhash64(text).alias("_m1"), F.xxhash64(F.lit(1), F.col(text)).alias("_m2")]
    key = ["_key", "_m1", "_m2"]

    @F.pandas_udf(T.LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    keyed = plain.select(key_or_last(F.col(at)).alias("_key"), *marks, simhash(F.col(text)).alias("fp"))
    prints = stored(keyed.withColumn("id", F.col("_key")), "simhash")
    winners = _grouped(prints, radius).groupBy("root").agg(F.min(F.struct(*key)).alias("w")).select("w.*")
    winners = stored(winners, "simhash-kept")
    rest = F.xxhash64(*[F.col(f.name) for f in plain.schema.fields if not isinstance(f.dataType, T.MapType)])
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(rest))
    kept = plain.select("*", key_or_last(F.col(at)).alias("_key"), *marks).join(winners, key, "left_semi")
    return kept.withColumn("_rank", rank).where("_rank = 1").select(*names).toDF(*df.columns)
