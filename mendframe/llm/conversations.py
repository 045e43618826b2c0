"""Repair of the role structure of conversations by a shortest path with scalar big-integer weights.

Edits turn the roles of a conversation into `(s?(ua)+)?` by their initials: Keep (0), Rerole to user or
assistant (3), Delete (4; the only edit of a blank or repeated row), Insert of an empty user or assistant
row (3); a truncated row that stays adds 3. A path through the graph of (rows done, state of the
grammar) has one integer as its weight: the cost in the high digits, then one digit of fixed width for
each letter of the audit in its order, zeros after the last. The smaller integer is the cheaper repair
and, of equal cost, the one whose audit is least in ASCII. Two paths to the same node never have equal
cost and audits of which one begins the other (further letters could only be inserts, which cost), so
the minimum at each node decides, and the audit is read off the digits.

Rows are folded to distinct ones with counts, ranged over tasks in the order of conversation and turn
and cut into segments of SEGMENT rows. A conversation that lies in one segment of one task is repaired
there. Segments of longer or divided ones give a table of 4 x 4 weights each, from every state to every
state, and the tables are chained by the same minimum: a long conversation is spread over tasks, and
what meets in one is its audit, 16 ways at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from mendframe.llm.common import stored

#: Rows of a segment.
SEGMENT = 256
#: Characters of a text that help to range rows of the same conversation, turn and role over tasks.
PREFIX = 64
SLICE = 256
BITS = 3
LETTERS = "DIKR"  # in ASCII order: digits 1 to 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: From a state by an initial; a row given a role, or inserted, moves as that initial.
MOVES = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

Row = tuple[str, bool, bool]  # initial, must go, truncated
Path = tuple[int, int]  # weight, letters so far


class Weights:
    """Weights of paths of at most `width` letters."""

    def __init__(self, width: int):
        self.width = width

    def step(self, path: Path, letter: str, cost: int) -> Path:
        weight, n = path
        return weight + (cost << BITS * self.width) + (LETTERS.index(letter) + 1 << BITS * (self.width - 1 - n)), n + 1

    def join(self, path: Path, cost: int, audit: str) -> Path:
        """A path followed by one of known cost and audit."""
        digits = int("".join(str(LETTERS.index(x) + 1) for x in audit) or "0", 1 << BITS)
        weight, n = path
        return weight + (cost << BITS * self.width) + (digits << BITS * (self.width - n - len(audit))), n + len(audit)

    def read(self, path: Path) -> tuple[int, str]:
        """(cost, audit)"""
        weight, n = path
        letters = oct((weight & (1 << BITS * self.width) - 1) >> BITS * (self.width - n))[2:] if n else ""
        return weight >> BITS * self.width, "".join(LETTERS[int(x) - 1] for x in letters)


def _least(paths: dict[int, Path], state: int, path: Path) -> None:
    if state not in paths or path[0] < paths[state][0]:
        paths[state] = path


def _inserted(paths: dict[int, Path], weights: Weights) -> dict[int, Path]:
    """Paths after any inserts: to user first, then to assistant; a further one would come back to a state for nothing."""
    out = dict(paths)
    for initial in "ua":
        for state, path in list(out.items()) if initial == "a" else list(paths.items()):
            if state in MOVES[initial]:
                _least(out, MOVES[initial][state], weights.step(path, "I", INSERT))
    return out


def shortest(rows: list[Row], paths: dict[int, Path], weights: Weights) -> dict[int, Path]:
    """The least path to every state after all rows, from those given; inserts after the last row are not yet in."""
    for initial, gone, truncated in rows:
        at, paths = _inserted(paths, weights), {}
        for state, path in at.items():
            _least(paths, state, weights.step(path, "D", DELETE))
            if gone:
                continue
            more = TRUNCATED if truncated else 0
            if state in MOVES.get(initial, ()):
                _least(paths, MOVES[initial][state], weights.step(path, "K", KEEP + more))
            for other in "ua":
                if state in MOVES[other]:
                    _least(paths, MOVES[other][state], weights.step(path, "R", REROLE + more))
    return paths


def _ended(paths: dict[int, Path], weights: Weights) -> Path:
    paths = _inserted(paths, weights)
    return min(paths[s] for s in ACCEPTED if s in paths)


def repair(rows: list[Row]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a whole conversation."""
    weights = Weights(3 * len(rows) + 2)
    return weights.read(_ended(shortest(rows, {START: (0, 0)}, weights), weights))


def table(rows: list[Row]) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) of the least paths of a segment between all states."""
    weights = Weights(3 * len(rows) + 2)
    return [(s, t, *weights.read(p)) for s in range(4) for t, p in shortest(rows, {s: (0, 0)}, weights).items()]


def chain(tables: list[list[tuple[int, int, int, str]]], width: int) -> tuple[int, str, list[tuple[int, str]]]:
    """(cost, audit, (state before, audit) of each segment) of the cheapest repair through all segments."""
    weights = Weights(width)
    paths, back = {START: (0, 0)}, []
    for entries in tables:
        after: dict[int, Path] = {}
        origin: dict[int, tuple[int, str]] = {}
        for s, t, cost, audit in entries:
            if s in paths:
                path = weights.join(paths[s], cost, audit)
                if t not in after or path[0] < after[t][0]:
                    after[t], origin[t] = path, (s, audit)
        back.append(origin)
        paths = after
    cost, audit = weights.read(_ended(paths, weights))
    # the end state before the last inserts is the one whose path begins the whole audit
    state = next(t for t, p in paths.items() if audit.startswith(weights.read(p)[1]) and set(audit[p[1] :]) <= {"I"})
    steps = []
    for origin in reversed(back):
        state, part = origin[state]
        steps.append((state, part))
    return cost, audit, steps[::-1]


def apply(audit: str, rows: list[tuple[str, str]], state: int = START) -> list[tuple[str, str]]:
    """The repaired (role, text) rows of a stretch that begins in a state of the grammar."""
    out, source = [], iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(source)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == USER else "user"
        state = MOVES[role[:1]][state]
        out.append((role, text))
    return out


def _segment(task: int, number: int, whole: bool, conv: object, held: list[tuple]) -> dict:
    """A stretch of rows (turn, role, text, blank, truncated) of a conversation with its counts; repaired if it is the whole of it."""
    seen: set[tuple[str, str]] = set()
    again = []
    for _, role, text, blank, _ in held:
        again.append(not blank and (role, text) in seen)
        seen.add((role, text))
    turns = {r[0] for r in held if r[0] is not None}
    initials = [r[1][:1] for r in held]
    out = {
        "conv": conv,
        "task": task,
        "number": number,
        "whole": whole,
        "n": len(held),
        "least": min(turns, default=None),
        "most": max(turns, default=None),
        "turns": len(turns),
        "head": initials[0] if held else None,
        "tail": initials[-1] if held else None,
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "blank": sum(r[3] for r in held),
    }
    if not whole:
        # whether a row stood earlier is not known here; texts of blank rows go whatever comes
        return out | {"rows": [{"role": r[1], "text": "" if r[3] else r[2], "gone": r[3], "truncated": r[4]} for r in held]}
    cost, audit = repair([(i, r[3] or d, r[4]) for i, r, d in zip(initials, held, again, strict=True)])
    rows = [{"role": role, "text": text} for role, text in apply(audit, [(r[1], r[2]) for r in held])]
    cut = sum(r[4] and not r[3] and not d for r, d in zip(held, again, strict=True))
    return out | {"duplicate": sum(again), "truncated": cut, "cost": cost, "audit": audit, "rows": rows}


def _segments(batches: Iterator[pa.RecordBatch], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Ordered rows of a task as segments; only a conversation that lies between two others here is known to be whole."""
    task, out, held = TaskContext.get().partitionId(), [], []
    conv, number, opened = None, 0, -1
    for row in (r for batch in batches for part in range(0, len(batch), SLICE) for r in batch.slice(part, SLICE).to_pylist()):
        if opened < 0 or row["conv"] != conv:
            if opened >= 0:
                out.append(_segment(task, number, number == 0 and opened > 0, conv, held))
            conv, number, opened, held = row["conv"], 0, opened + 1, []
        for _ in range(row["copies"] if row["present"] else 0):
            if len(held) == size:
                out.append(_segment(task, number, False, conv, held))
                number, held = number + 1, []
            held.append((row["turn"], row["role"], row["text"], row["blank"], row["truncated"]))
        if len(out) >= SLICE:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if opened >= 0:
        out.append(_segment(task, number, False, conv, held))
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _tables(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Segments with the rows that live in the conversation, with their tables of weights."""
    for batch in batches:
        for segment in (s for i in range(len(batch)) for s in batch.slice(i, 1).to_pylist()):
            live = set(segment.pop("live") or ())
            again = [not r["gone"] and i not in live for i, r in enumerate(segment["rows"])]
            segment["duplicate"] = sum(again)
            segment["truncated"] = sum(r["truncated"] and i in live for i, r in enumerate(segment["rows"]))
            rows = [(r["role"][:1], i not in live, r["truncated"]) for i, r in enumerate(segment["rows"])]
            segment["entries"] = [dict(zip(("s", "t", "cost", "audit"), e, strict=True)) for e in table(rows)]
            yield pa.RecordBatch.from_pylist([segment], schema=schema)


def _chained(segments: pa.Table, schema: pa.Schema) -> pa.Table:
    """One conversation from its segments: counts, cost, audit, and the path of each segment."""
    parts = sorted(segments.to_pylist(), key=lambda s: (s["task"], s["number"]))
    cost, audit, steps = chain([[(e["s"], e["t"], e["cost"], e["audit"]) for e in s["entries"]] for s in parts], sum(3 * s["n"] + 2 for s in parts) + 2)
    rest = audit[sum(len(a) for _, a in steps) :]
    steps[-1] = (steps[-1][0], steps[-1][1] + rest)
    full = [s for s in parts if s["n"]]
    timed = [s for s in parts if s["turns"]]
    turns = sum(s["turns"] for s in timed) - sum(a["most"] == b["least"] for a, b in zip(timed, timed[1:], strict=False))
    illegal = sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(full, full[1:], strict=False))
    out = {
        "cid": parts[0]["cid"],
        "conv": parts[0]["conv"],
        "gaps": timed[-1]["most"] - timed[0]["least"] + 1 - turns if timed else 0,
        "illegal": illegal + sum(s["illegal"] for s in parts),
        "cost": cost,
        "audit": audit,
        "path": [{"task": p["task"], "number": p["number"], "state": s, "part": a} for p, (s, a) in zip(parts, steps, strict=True)],
    }
    return pa.Table.from_pylist([out | {c: sum(s[c] for s in parts) for c in ("blank", "duplicate", "truncated")}], schema=schema)


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in (x for i in range(len(batch)) for x in batch.slice(i, 1).to_pylist()):
            rows = apply(r["part"], [(x["role"], x["text"]) for x in r["rows"]], r["state"])
            out = {c: r[c] for c in ("cid", "conv", "task", "number")} | {"rows": [{"role": a, "text": b} for a, b in rows]}
            yield pa.RecordBatch.from_pylist([out], schema=schema)


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Digest of the lines of each conversation, whose pieces come in order; no more than a piece is held."""
    cid, digest, begun = None, None, False
    for batch in batches:
        for r in (x for i in range(len(batch)) for x in batch.slice(i, 1).to_pylist()):
            if r["cid"] != cid:
                if digest:
                    yield pa.RecordBatch.from_pylist([{"cid": cid, "repaired_sha256": digest.hexdigest()}], schema=schema)
                cid, digest, begun = r["cid"], hashlib.sha256(), False
            for row in r["rows"]:
                digest.update(("\n" * begun + f"{row['role']}:{row['text']}").encode())
                begun = True
    if digest:
        yield pa.RecordBatch.from_pylist([{"cid": cid, "repaired_sha256": digest.hexdigest()}], schema=schema)


ROWS = "array<struct<role string, text string>>"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


@dataclass(frozen=True)
class Repaired:
    """conversations: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. pieces: conv, task,
    number, rows: the repaired rows in the order of task and number, one piece for all but long or divided conversations."""

    conversations: DataFrame
    pieces: DataFrame


def repair_conversations(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present_col: str | None = None,
    segment: int = SEGMENT,
) -> Repaired:
    """The cheapest repair of every conversation and the faults found in it.

    Rows are ordered by turn (nulls first), then role, then text, so repeated rows stand side by side. Null
    roles and texts count as one blank; rows without a conversation form one of their own. A row whose
    `present_col` is false or null only names its conversation, which has no rows if all are such: counts of
    zero, an empty audit, the digest of nothing. Blank rows and rows whose role and text stood earlier must
    go; long texts are whole; an empty table gives empty results; other columns are not read. Rows of a
    conversation are spread over tasks by turn, role and the first PREFIX characters of the text.
    """
    conv_type = df.schema[conv_col].dataType.simpleString()
    present = F.coalesce(F.col(present_col), F.lit(False)) if present_col else F.lit(True)
    rows = df.select(
        F.col(conv_col).alias("conv"),
        F.when(present, F.col(turn_col).cast("long")).alias("turn"),
        F.when(present, F.coalesce(F.col(role_col), F.lit(" "))).otherwise("").alias("role"),
        F.when(present, F.coalesce(F.col(text_col), F.lit(" "))).otherwise("").alias("text"),
        present.alias("present"),
    )
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    blank = ~F.col("text").rlike(BLANK)
    rows = rows.withColumn("blank", blank).withColumn("truncated", ~blank & ~F.col("text").rlike(ENDED))
    rows = rows.repartitionByRange("conv", "turn", "role", F.substring("text", 1, PREFIX)).sortWithinPartitions("conv", "turn", "role", "text")

    def over(fn, schema: str, **more):
        return partial(fn, schema=to_arrow_schema(T._parse_datatype_string(schema)), **more)

    found = f"""conv {conv_type}, task int, number long, whole boolean, n long, least long, most long, turns long, head string, tail string,
        illegal long, blank long, duplicate long, truncated long, cost long, audit string"""
    full = "array<struct<role string, text string, gone boolean, truncated boolean>>"
    segments = stored(rows.mapInArrow(over(_segments, f"{found}, rows {full}", size=segment), f"{found}, rows {full}"), "segments")
    segments = segments.withColumn("cid", F.to_json(F.struct("conv")))
    whole, divided = segments.where("whole"), segments.where("not whole")

    # of rows with the same role and text, the first of the conversation lives
    each = divided.select("cid", "task", "number", F.posexplode("rows").alias("at", "row")).where("not row.gone")
    first = each.groupBy("cid", "row.role", F.sha2("row.text", 256)).agg(F.min(F.struct("task", "number", "at")).alias("first"))
    live = first.groupBy("cid", "first.task", "first.number").agg(F.collect_list("first.at").alias("live"))
    narrow = ["cid", "conv", "task", "number", "n", "least", "most", "turns", "head", "tail", "illegal", "blank"]
    entries = "entries array<struct<s int, t int, cost long, audit string>>"
    kind = f"""cid string, conv {conv_type}, task int, number long, n long, least long, most long, turns long, head string, tail string,
        illegal long, blank long, rows {full}, duplicate long, truncated long, {entries}"""
    divided = divided.select(*narrow, "rows").join(live, ["cid", "task", "number"], "left")
    tables = stored(divided.mapInArrow(over(_tables, kind), kind), "segment-tables")

    kind = f"""cid string, conv {conv_type}, gaps long, illegal long, cost long, audit string,
        path array<struct<task int, number long, state int, part string>>, blank long, duplicate long, truncated long"""
    schema = to_arrow_schema(T._parse_datatype_string(kind))
    chained = stored(tables.drop("rows").groupBy("cid").applyInArrow(lambda t: _chained(t, schema), kind), "chains")
    steps = chained.select("cid", F.explode("path").alias("p")).select("cid", "p.*")
    kind = f"cid string, conv {conv_type}, task int, number long, rows {ROWS}"
    pieces = tables.select("cid", "conv", "task", "number", "rows").join(steps, ["cid", "task", "number"]).mapInArrow(over(_pieces, kind), kind)
    pieces = stored(pieces, "repaired")
    ordered = pieces.repartition("cid").sortWithinPartitions("cid", "task", "number")
    digests = ordered.mapInArrow(over(_digests, "cid string, repaired_sha256 string"), "cid string, repaired_sha256 string")

    lines = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0))
    done = whole.withColumn("gaps", gaps).select("conv", *COUNTS, F.sha2(lines, 256).alias("repaired_sha256"))
    chains = chained.join(digests, "cid").select("conv", *COUNTS, "repaired_sha256")
    own = whole.select("conv", "task", "number", F.transform("rows", lambda r: F.struct(r["role"], r["text"])).cast(ROWS).alias("rows"))
    return Repaired(done.unionByName(chains), own.unionByName(pieces.drop("cid")))


def damaged(df: DataFrame) -> DataFrame:
    """conversations rows with faults told by the checksum of `conv_id:turn` (nulls: one blank); `present` is false where a row is dropped."""
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(named.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return df.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
