import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from mendframe.llm import token_counts as counts

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def plain(offsets, bounds, rule):
    """Tokens by section, one token and one section at a time."""
    out, crossing = [0.0] * (len(bounds) - 1), 0
    for a, b in offsets:
        shares = [max(0, min(b, bounds[i + 1]) - max(a, bounds[i])) for i in range(len(bounds) - 1)]
        crossing += sum(s > 0 for s in shares) > 1
        if rule == "first":
            out[next(i for i, s in enumerate(shares) if s)] += 1
        elif rule == "most":
            out[shares.index(max(shares))] += 1
        else:
            out = [o + s / sum(shares) for o, s in zip(out, shares, strict=True)]
    return out, crossing


def test_sections_of_tables(documents, hostile, nothing):
    tokenizer = library()
    for table in (documents, hostile):
        for rule in counts.RULES:
            rows = counts.section_counts(table, PATH, PATTERN, rule=rule).collect()
            got = sorted((str(r["id"]), r["section"], r["start"], r["end"], round(r["n_tokens"], 6), r["total_tokens"], r["n_crossing"]) for r in rows)
            want = []
            for r in table.collect():
                text = r["text"] or ""
                if len(text) > 100_000 and rule != "first":
                    got = [g for g in got if g[0] != str(r["doc_id"])]
                    continue
                bounds = counts.line_bounds(text).tolist()
                offsets = tokenizer.encode(text, add_special_tokens=False).offsets
                by_section, crossing = plain(offsets, bounds, rule)
                want += [(str(r["doc_id"]), i, bounds[i], bounds[i + 1], round(n, 6), len(offsets), crossing) for i, n in enumerate(by_section)]
            assert got == sorted(want)
    assert counts.section_counts(nothing, PATH, PATTERN).count() == 0


def test_boundaries_within_tokens():
    starts, ends = np.array([0, 3, 5]), np.array([3, 5, 12])
    bounds = np.array([0, 1, 1, 6, 12])
    assert counts.attribute(starts, ends, bounds, "first")[0].tolist() == [1, 0, 2, 0]
    assert counts.attribute(starts, ends, bounds, "most")[0].tolist() == [0, 0, 2, 1]
    split, crossing = counts.attribute(starts, ends, bounds, "split")
    assert crossing == 2 and np.allclose(split, [1 / 3, 0, 2 / 3 + 1 + 1 / 7, 6 / 7])


def test_fields(spark):
    table = spark.createDataFrame([(1, "user", "Hello there"), (None, None, None), (2, "", "é" * 9)], "conv_id long, role string, text string")
    rows = counts.field_counts(table, PATH, PATTERN, "conv_id", ["role", "text"]).collect()
    assert len(rows) == 6
    for conv, whole in ((1, "user\nHello there"), (2, "\n" + "é" * 9), (None, "\n")):
        mine = [r for r in rows if r["id"] == conv]
        assert sum(r["n_tokens"] for r in mine) == len(library().encode(whole, add_special_tokens=False).ids)
