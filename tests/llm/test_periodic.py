import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from mendframe.llm import periodic
from mendframe.llm.queries import REGISTRY

BLANKS = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in text or "":
        if c in BLANKS:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out + ([word] if word else [])


def brute(words):
    """All runs by trying every period and extending matches."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = words_of(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=60), max_size=4))
def test_runs_of_small_alphabets(texts):
    assert periodic.runs_of(texts) == [brute(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=6), st.integers(1, 9)), max_size=8))
def test_runs_of_repeated_blocks(blocks):
    words = [w for block, times in blocks for w in block * times]
    assert periodic.runs_of([words, words[::-1], []]) == [brute(words), brute(words[::-1]), []]


def test_one_long_run():
    assert periodic.runs_of([[7] * 30_000]) == [[(0, 30_000, 1)]]
    words = [*range(20_000), *([1, 2, 3] * 10_000)]
    assert periodic.runs_of([words]) == [[(20_000, 30_000, 3)]]


def test_many_left_words_of_one_passage():
    generator = random.Random(5)
    words = [w for k in range(400) for w in [100 + k, *[1] * generator.randint(3, 12)]]
    assert periodic.runs_of([words]) == [brute(words)]


def test_query_equals_brute_force(spark, folder, documents):
    wanted = sorted((expected(r["doc_id"], r["text"]) for r in documents.collect()), key=repr)
    assert rows(REGISTRY["op13_runs"](spark, folder)) == wanted
    assert sum(w[1] for w in wanted) > 0


def test_odd_rows(spark, hostile, nothing):
    found = periodic.find_runs(hostile).collect()
    assert len(found) == hostile.count() and periodic.find_runs(nothing).count() == 0
    texts = [words_of(r["text"]) for r in hostile.collect()]
    wanted = sorted((brute(w) for w in texts if len(w) < 1000), key=repr)
    assert sorted(([tuple(x) for x in r["runs"]] for r in found if r["n_words"] < 1000), key=repr) == wanted
    long = next(r for r in found if r["n_words"] == 60_000)
    assert [tuple(x) for x in long["runs"]] == [(0, 60_000, 3)] and long["collapsed"] == "lorem ipsum dolor."


def test_looped_words():
    for i in range(500):
        words = [b"w%d" % j for j in range(i % 17)]
        h = zlib.crc32(str(i).encode())
        wanted = words
        if h % 10 == 0 and words:
            a, p = h // 10 % len(words), 1 + (len(words) - h // 10 % len(words)) // (3 + h // 10 % 8)
            wanted = words[:a] + [words[a + (k - a) % p] for k in range(a, len(words))]
        assert periodic.looped(str(i), words) == wanted
    assert periodic.looped(None, [b"a"] * 9) == [b"a"] * 9
