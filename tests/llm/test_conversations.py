import hashlib
import heapq
import itertools
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mendframe.llm import conversations
from mendframe.llm.queries import REGISTRY

GRAMMAR = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def cheapest(rows):
    """(cost, audit, final roles) by a search over whole audits, least (cost, audit) first."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, roles = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit, roles
        for r in "ua":
            if (state, r) in GRAMMAR:
                heapq.heappush(heap, (cost + 3, audit + "I", i, GRAMMAR[state, r], (*roles, (r, None))))
        if i == len(rows):
            continue
        initial, gone, truncated = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, roles))
        if not gone:
            if (state, initial) in GRAMMAR:
                heapq.heappush(heap, (cost + 3 * truncated, audit + "K", i + 1, GRAMMAR[state, initial], (*roles, ("k", i))))
            for r in "ua":
                if (state, r) in GRAMMAR:
                    heapq.heappush(heap, (cost + 3 + 3 * truncated, audit + "R", i + 1, GRAMMAR[state, r], (*roles, (r, i))))
    raise AssertionError


def expected(rows):
    """Results of conversations from damaged rows (conv, turn, role, text, present)."""
    groups = defaultdict(list)
    for conv, turn, role, text, present in rows:
        held = groups[conv]
        if present:
            held.append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in held:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in held if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(held))
        cost, audit, roles = cheapest([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(held, faults, strict=True)])
        lines = [(held[i][1] if r == "k" else {"u": "user", "a": "assistant"}[r]) + ":" + ("" if i is None else held[i][2]) for r, i in roles]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest))
    return sorted(out, key=repr)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows(df, conv="conv"):
    return sorted((tuple(r) for r in df.select(conv, *COLUMNS).collect()), key=repr)


ROWS = st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=9)


@settings(max_examples=400, deadline=None)
@given(ROWS)
def test_weights_find_the_cheapest_and_least_audit(given_rows):
    assert conversations.repair(given_rows) == cheapest(given_rows)[:2]


@settings(max_examples=200, deadline=None)
@given(st.lists(ROWS, min_size=1, max_size=4))
def test_chained_segments_equal_the_whole(parts):
    whole = [r for p in parts for r in p]
    cost, audit, steps = conversations.chain([conversations.table(p) for p in parts], 3 * len(whole) + 2 * len(parts) + 2)
    assert (cost, audit) == cheapest(whole)[:2] and audit.startswith("".join(a for _, a in steps))


def test_a_long_segment():
    given_rows = [("su"[i % 7 == 0] if i % 3 else "a", i % 5 == 0, i % 4 == 0) for i in range(256)]
    assert conversations.repair(given_rows) == cheapest(given_rows)[:2]


HOSTILE = [
    *[(1, t, r, x, True) for t, r, x in [(0, "system", "Be kind."), (1, "user", "Hi?"), (2, "assistant", "Hello"), (2, "assistant", "Hello"), (5, "user", "Bye.")]],
    *[(2, None, None, None, True), (2, None, "user", "x.", True), (2, 3, "tool", "y.", True), (2, 3, "tool", "y.", True)],
    *[(None, 1, "user", "no id.", True), (None, 0, "", "  \t", True)],
    *[(3, 0, "user", "gone.", False), (3, 1, None, None, False)],
    *[(4, t, ("user", "assistant")[t % 2], f"text {t % 11}{'.' * (t % 3)}", True) for t in range(60)],
    *[(5, None, "user", "same.", True)] * 40,
    (6, 2**53 + 1, "user", "lorem " * 50_000, True),
    (6, 2**53 + 3, "assistant", "Ü.", True),
]


@pytest.mark.parametrize("segment", [3, 256])
def test_odd_rows(spark, segment):
    schema = "conv_id long, turn long, role string, text string, present boolean, conv string, task string, rows int"
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in HOSTILE], schema)
    found = conversations.repair_conversations(df, present_col="present", segment=segment)
    assert rows(found.conversations) == expected(HOSTILE)
    lines = defaultdict(list)
    for p in sorted(found.pieces.collect(), key=lambda p: (p["task"], p["number"])):
        lines[p["conv"]] += [f"{r['role']}:{r['text']}" for r in p["rows"]]
    digests = {r["conv"]: r["repaired_sha256"] for r in found.conversations.collect()}
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in lines.items()} == digests
    nothing = conversations.repair_conversations(df.limit(0), segment=segment)
    assert nothing.conversations.count() == 0 and nothing.pieces.count() == 0


def test_query_equals_brute_force(spark, folder):
    table = []
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        h = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if h == 1 else "".join(c for c in r["text"] if c not in ".!?") if h == 2 else r["text"]
        table += [(r["conv_id"], r["turn"], "user" if h == 4 else r["role"], text, h != 0)] * (2 if h == 3 else 1)
    assert rows(REGISTRY["op11_conversations"](spark, folder), "conv_id") == expected(table)
