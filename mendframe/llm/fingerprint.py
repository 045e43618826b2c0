"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A paragraph is a stretch between line breaks or sentence ends; a text is the set of its paragraphs'
64-bit digests. A sketch has three subtables of cells (count, xor of digests, xor of their check
hashes); a digest adds to one cell of each. The fingerprint is such a sketch of fixed size, as text.

Two versions are compared by subtracting their sketches cell by cell: what they share cancels, and
peeling (a cell with count 1 or -1 whose check hash fits gives up its digest, which then leaves its
other cells) recovers the digests that differ, with the side they stand on. Fingerprints that were
stored as text can be subtracted in the same way (`stored_difference`). Where peeling stalls, both
versions get larger sketches: first a block of cells for every few digests, blocks being chosen by bits
of the digest, then a block that stalls is rebuilt for both versions at twice the width, with new
hashes, until it peels. All of it is SQL on one row; a block is small, so the work grows with the
number of paragraphs, not with its square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARAGRAPH = r"\n+|(?<=[.!?])\s+"
WIDTH = 4
GROUP = 5
#: A block that stalls 16 times doubles up to 2^18 cells a subtable; for some ten digests that is not reached.
DOUBLINGS = 16
FOUND = "array<struct<d:bigint,s:int>>"
BUCKETS_PER_PARTITION = 4
SIDE = 32


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text; null has none."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), PARAGRAPH), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _places(digest: str, width: str, salt: str | None) -> str:
    """A digest's cell in each of the three subtables; another salt hashes anew."""
    mixed = digest if salt is None else f"xxhash64({digest}, {salt})"
    places = ", ".join(f"{t} * {width} + pmod(shiftright({mixed}, {18 + 15 * t}), {width})" for t in range(3))
    return f"array({places})"


def sketch(digests: str, width: str = f"{WIDTH}L", salt: str | None = None) -> str:
    """SQL: the sketch of an array of digests, as an array of (n, k, h)."""
    placed = f"transform({digests}, d -> named_struct('d', d, 'h', xxhash64(d), 'c', {_places('d', width, salt)}))"
    subtables = ", ".join(
        f"transform(sequence({t} * {width}, {t + 1} * {width} - 1L), c -> aggregate(filter(y, x -> x.c[{t}] = c), "
        "named_struct('n', 0, 'k', 0L, 'h', 0L), (a, x) -> named_struct('n', a.n + 1, 'k', a.k ^ x.d, 'h', a.h ^ x.h)))"
        for t in range(3)
    )
    return f"transform(array({placed}), y -> concat({subtables}))[0]"


def subtracted(ours: str, theirs: str) -> str:
    """SQL: one sketch less another of the same width and salt."""
    return f"zip_with({ours}, {theirs}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h))"


def peeled(table: str, width: str = f"{WIDTH}L", salt: str | None = None) -> str:
    """SQL: the digests (d, s) that peeling recovers from a subtracted sketch, null where cells are left over; s is 1 for
    a digest of the first version and -1 for one of the second."""
    found = (
        "array_distinct(transform(filter(t, c -> abs(c.n) = 1 and xxhash64(c.k) = c.h), c -> named_struct('d', c.k, 's', c.n, 'h', c.h)))"
    )
    pure = f"transform({found}, c -> named_struct('d', c.d, 's', c.s, 'h', c.h, 'c', {_places('c.d', width, salt)}))"
    stripped = (
        "transform(s.t, (c, i) -> aggregate(filter(s.p, p -> array_contains(p.c, cast(i as bigint))), c, "
        "(a, p) -> named_struct('n', a.n - p.s, 'k', a.k ^ p.d, 'h', a.h ^ p.h)))"
    )
    # a round strips what the last one found; the next finds anew
    gained = "concat(s.f, transform(s.p, p -> named_struct('d', p.d, 's', p.s)))"
    step = f"if(size(s.p) = 0, s, transform(array({stripped}), t -> named_struct('t', t, 'p', {pure}, 'f', {gained}))[0])"
    start = f"transform(array({table}), t -> named_struct('t', t, 'p', {pure}, 'f', cast(array() as {FOUND})))[0]"
    end = f"if(forall(s.t, c -> c.n = 0 and c.k = 0 and c.h = 0), s.f, cast(null as {FOUND}))"
    return f"aggregate(sequence(1L, 3L * {width}), {start}, (s, r) -> {step}, s -> {end})"


def _dealt(digests: str) -> str:
    """SQL: an array of digests as 2^bits_ arrays by their low bits, in two steps, so that dealing stays cheap for long texts."""
    half = "(bits_ div 2)"
    return (
        "flatten(transform("
        f"transform(sequence(0, cast(shiftleft(1, {half}) - 1 as int)), g_ -> filter({digests}, x -> (x & (shiftleft(1L, {half}) - 1)) = g_)), "
        f"part -> transform(sequence(0, cast(shiftleft(1, bits_ - {half}) - 1 as int)), "
        f"g_ -> filter(part, x -> (shiftright(x, {half}) & (shiftleft(1L, bits_ - {half}) - 1)) = g_))))"
    )


def difference(ours: str, theirs: str, our_sketch: str | None = None, their_sketch: str | None = None) -> str:
    """SQL: the digests (d, s) that stand in one of two arrays only, by subtracted sketches of growing size.

    The fixed-size sketches of the arrays may be given where they are columns already.
    """
    fixed = subtracted(our_sketch or sketch(ours), their_sketch or sketch(theirs))
    # a sketch cannot give up more digests than it has cells
    small = f"if(abs(size({ours}) - size({theirs})) > {3 * WIDTH}, cast(null as {FOUND}), {peeled(fixed)})"
    bits = f"cast(greatest(0, ceil(log2(greatest(1, size({ours}) + size({theirs})) / {GROUP}))) as int)"
    block = peeled(subtracted(sketch("o", "w", "w"), sketch("q", "w", "w")), "w", "w")
    doubling = f"coalesce(got, transform(array(shiftleft({WIDTH}L, cast(twice as int))), w -> {block})[0])"
    until = f"aggregate(sequence(0, {DOUBLINGS}), cast(null as {FOUND}), (got, twice) -> {doubling})"
    blocks = f"zip_with({_dealt(ours)}, {_dealt(theirs)}, (o, q) -> coalesce({until}, raise_error('a block of the sketch does not peel')))"
    return f"coalesce({small}, transform(array({bits}), bits_ -> flatten({blocks}))[0])"


def likeness(ours: str, theirs: str, our_sketch: str | None = None, their_sketch: str | None = None) -> Column:
    """Shared digests over all digests (0 to 1) of two array columns; 1 where both are empty."""
    both = f"size({ours}) + size({theirs})"
    differing = f"size({difference(ours, theirs, our_sketch, their_sketch)})"
    return F.expr(f"transform(array({differing}), n_ -> if({both} = 0, 1.0D, ({both} - n_) / cast({both} + n_ as double)))[0]")


def sketch_text(digests: str, cells: str) -> Column:
    """The fingerprint: number of digests, then the cells of the fixed-size sketch with their check hashes, in hexadecimal."""
    cell = "concat(hex(c.n), '.', lpad(hex(c.k), 16, '0'), '.', lpad(hex(c.h), 16, '0'))"
    return F.expr(f"concat(hex(size({digests})), '-', array_join(transform({cells}, c -> {cell}), '-'))")


def sketch_of_text(fingerprint: str) -> str:
    """SQL: the cells that a fingerprint holds."""
    parts = f"transform(slice(split({fingerprint}, '-'), 2, {3 * WIDTH}), c -> split(c, '[.]'))"
    number = "cast(conv({}, 16, -10) as {})"
    cell = f"named_struct('n', {number.format('c[0]', 'int')}, 'k', {number.format('c[1]', 'bigint')}, 'h', {number.format('c[2]', 'bigint')})"
    return f"transform({parts}, c -> {cell})"


def stored_difference(ours: str, theirs: str) -> Column:
    """The paragraph digests (d, s) in which the texts of two fingerprint columns differ, from the fingerprints alone.

    Null where the texts differ in more digests than sketches of the fixed size give up, or a fingerprint is null.
    """
    return F.expr(peeled(subtracted(sketch_of_text(f"`{ours}`"), sketch_of_text(f"`{theirs}`"))))


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """`df` with the fingerprint of every whole text; equal texts have equal ones, null counts as empty."""
    named = {c: f"c{i}" for i, c in enumerate(df.columns)}
    keep = [c for c in df.columns if c != out_col]
    marked = df.toDF(*named.values()).withColumn("_digests", digests(F.col(named[text_col])))
    return marked.select(*[named[c] for c in keep], sketch_text("_digests", sketch("_digests")).alias("_f")).toDF(*keep, out_col)


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, next_text, and both texts' digests): the next row by descending id; after the last comes the first.

    Rows are dealt by ranges of ids, whose bounds are approximate quantiles, and each range looks ahead
    on its own; the first row of every range, one per range, is handed to the range before it.
    """
    spark = df.sparkSession
    least = -(2**63)
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(least))
    rows = df.select(order.alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = min(SIDE * SIDE, BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("id", shares, 20 * ranges)).first()[0] or [] if shares else []
    bounds = sorted(set(bounds))
    chunks = [bounds[i : i + SIDE] for i in range(0, len(bounds), SIDE)]
    if bounds:
        coarse = F.array(*[F.lit(c[0]) for c in chunks])
        fine = F.array(*[F.array(*[F.lit(b) for b in c]) for c in chunks])
        # the number of bounds below the id: whole chunks first, then within the last one
        at = F.size(F.filter(coarse, lambda b: b <= F.col("id")))
        inside = F.size(F.filter(F.element_at(fine, at), lambda b: b <= F.col("id")))
        place = F.when(at > 0, (at - 1) * SIDE + inside).otherwise(F.lit(0))
    else:
        place = F.lit(0)
    placed = rows.withColumn("range", place.cast("int")).withColumns({"hash": F.xxhash64("text"), "d": digests(F.col("text"))})
    ahead = Window.partitionBy("range").orderBy(F.desc("id"), "hash")
    first = placed.groupBy("range").agg(F.max_by("text", F.struct("id", -F.col("hash"))).alias("head_text"))
    met = sorted((r["range"] for r in placed.select("range").distinct().collect()), reverse=True)
    # descending ids run through the ranges from the last to the first, and round again
    follows = {a: b for a, b in zip(met, met[1:] + met[:1], strict=True)}
    pairs = [x for a, b in follows.items() for x in (F.lit(b), F.lit(a))]
    before = F.create_map(*pairs)[F.col("range")] if pairs else F.lit(0)
    heads = first.select(before.cast("int").alias("range"), "head_text", digests(F.col("head_text")).alias("head_d"))
    looked = placed.withColumns({"next_text": F.lead("text").over(ahead), "next_d": F.lead("d").over(ahead)})
    whole = looked.join(heads, "range")
    return whole.select(
        F.when(F.col("id") != least, F.col("id")).alias("id"),
        "text",
        F.coalesce("next_text", "head_text").alias("next_text"),
        "d",
        F.coalesce("next_d", "head_d").alias("next_d"),
    )


def versions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited version, and how alike they and the next text are.

    One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has its last third (rounded down, in code points) replaced by as many
    code points of the beginning of the next text, or all it has. Next is the row with the next smaller
    id, after the last the first; rows of one id follow by the hash of their text; null ids come last.
    Null texts count as empty; a single row is its own next. An empty table gives an empty result.
    Other columns are not read.
    """
    rows = with_next(df, id_col, text_col)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = rows.select("id", n.cast("long").alias("n_chars"), edited.alias("edited"), "d", "next_d")
    rows = rows.select("id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digests(F.col("edited")).alias("e"), "d", "next_d")
    rows = rows.select("*", F.expr(sketch("d")).alias("ds"), F.expr(sketch("e")).alias("es"))
    return rows.select(
        "id",
        "n_chars",
        "edited_sha256",
        sketch_text("d", "ds").alias("fingerprint"),
        sketch_text("e", "es").alias("edited_fingerprint"),
        likeness("d", "e", "ds", "es").alias("near_edited"),
        likeness("d", "next_d", "ds").alias("near_next"),
    )
