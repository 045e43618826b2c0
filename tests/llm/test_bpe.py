import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from mendframe.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation(), tokenizer.no_padding()
    return tokenizer


def test_ids_as_the_library():
    generator = random.Random(1)
    pieces = ["a", "b", "é", "é", "'", "s", "S", " ", "\n", "1", "Σ", "<|endoftext|>", "the", "!", " ", " ", "İ", "ー", "ß", "\x1f", "क्ष", "😀"]
    texts = ["", "   ", "aaaaaaaaaaaa aaa a", "ΑΣ ΟΔΥΣΣΕΥΣ", "'re'LL <|ENDOFTEXT|>", "x" * 5000]
    texts += ["".join(generator.choice(pieces) for _ in range(generator.randrange(1, 14))) for _ in range(2000)]
    tokenizer, encoder = library(), bpe.Encoder(bpe.Vocabulary(PATH))
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_cache_of_words_overflows(monkeypatch):
    monkeypatch.setattr(bpe, "WORD_CACHE", 3)
    monkeypatch.setattr(bpe, "PART", 4)
    tokenizer, encoder = library(), bpe.Encoder(bpe.Vocabulary(PATH))
    texts = ["one two three four five six", "seven one", "", "eight nine ten one two"] * 2
    assert [x.tolist() for x in encoder.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_round_trip_of_tables(spark, documents, hostile, nothing):
    tokenizer = library()
    for table in (documents, hostile):
        rows = bpe.decode(bpe.encode(table, PATH), PATH)
        assert rows.columns == [*table.columns, "ids", "decoded"]
        for r in rows.collect():
            ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids
            assert r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)
        both = bpe.encode_decode(table, PATH)
        assert both.columns == rows.columns and both.exceptAll(rows).isEmpty() and rows.exceptAll(both).isEmpty()
    assert bpe.decode(bpe.encode(nothing, PATH), PATH).count() == 0 and bpe.encode_decode(nothing, PATH).count() == 0
    odd = spark.createDataFrame([(None,), (bytes([255] * 4),)], "ids binary")
    assert [r["decoded"] for r in bpe.decode(odd, PATH).collect()] == ["", ""]


def test_query_digests(spark, folder, documents):
    from mendframe.llm.queries import REGISTRY

    tokenizer = library()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in REGISTRY["op2_bpe"](spark, folder).collect():
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
