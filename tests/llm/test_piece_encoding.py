"""Operator 11 against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from geoincident.llm import piece_encoding

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return piece_encoding.pieces(MODEL)


def same(own, library, texts):
    got = [x.tolist() for x in own.encode([t.encode() for t in texts])]
    assert got == library.encode(texts)
    assert [own.decode(x) for x in got] == library.decode(got)


def test_fuzz(own, library):
    rnd = random.Random(5)
    parts = [" ", "  ", " " * 7, " " * 40, "the", "in", "\n", "\t", "▁", "é", "ß", "日本", "語", "😀", "́", "<s>", "<0x0A>",
             "</s>", "<unk>", "0", "=", "==", "//", "....", "aaa", "ssss", "\x00", "nn", "ll", "À", "￿"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(2000)]
    texts += ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(300))) for _ in range(300)]
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.vocab_size())]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(50))) for _ in range(3000)]
    same(own, library, texts)


def test_long_and_blank_texts(own, library):
    rnd = random.Random(6)
    word = "".join(rnd.choice("abcdef") for _ in range(9000))  # beyond LONG_STRETCH: the queue
    same(own, library, ["", " ", "  ", " " * 5000, "=" * 3000, "a" * 5000 + " b " + "c" * 4096, word + " end", "x " * 40000])


def test_rounds_equal_the_queue(own):
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abehinorst -=") for _ in range(rnd.randrange(1, 200))) for _ in range(300)]
    for w in words:
        symbols = own.chars[[ord(c) for c in w]]
        merged, _ = own.merge(symbols, np.array([len(w)]))
        assert merged.tolist() == own.queue(symbols.tolist()).tolist()


def test_decode_of_any_ids(own, library):
    rnd = random.Random(8)
    kinds = [lambda: rnd.randrange(32000), lambda: rnd.randrange(3, 259), lambda: rnd.randrange(3), lambda: 29871]
    ids = [[rnd.choice(kinds)() for _ in range(rnd.randrange(12))] for _ in range(5000)]
    assert [own.decode(x) for x in ids] == [library.decode(x) for x in ids]
    with pytest.raises(ValueError, match="outside"):
        own.decode([32000])


def test_equal_hashes_are_told_apart(own, library, monkeypatch):
    monkeypatch.setattr(piece_encoding, "hash_spans", lambda low, begin, end: (end - begin).astype("u8"))
    same(own, library, ["the cat sat on the mat", "a longwordhere otherwordxx longwordherf"])


def test_query_against_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = piece_encoding.op11_piece_encoding(spark, SF).collect()
    assert len(got) == len(texts)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in got:
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(",".join(map(str, ids))) and r["decoded_sha256"] == sha(library.decode(ids))


def test_edge_cases(spark):
    rows = spark.createDataFrame([(1, None, 7, "c"), (1, "", 8, None), (None, "a b", 9, "c"), (2, "a b", 9, "c"), (2, "a b", 9, "c")],
                                 "doc_id long, text string, ids int, decoded string")
    both = piece_encoding.decode(piece_encoding.encode(rows, MODEL), MODEL)
    assert sorted(both.columns) == sorted(rows.columns) and both.schema["ids"].dataType.simpleString() == "array<int>"
    out = both.collect()
    assert [r["decoded"] for r in out] == ["", "", "a b", "a b", "a b"] and [len(r["ids"]) for r in out][:2] == [0, 0]
    assert piece_encoding.decode(piece_encoding.encode(rows.limit(0), MODEL), MODEL).count() == 0
    null = spark.createDataFrame([(None,), ([450, 6635],)], "ids array<int>")
    assert [r["decoded"] for r in piece_encoding.decode(null, MODEL).collect()] == ["", "de bag"]
    assert piece_encoding.encode(rows, MODEL, ids_col="out").where(F.size("out") > 0).count() == 3
