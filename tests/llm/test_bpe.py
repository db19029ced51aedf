import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratus.llm import bpe

LIB = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))


def expected(text):
    ids = LIB.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def texts():
    rng = random.Random(4)
    pool = "abcdefgthnsr" * 4 + "éüßñЖ中文字🙂'’!?.,-0123456789"
    yield from (None, "", " \t\n", "a", "It's THE cat's, isn't it?", "étude  café", "x y z\x1cw", "<|endoftext|> a<|startoftext|>b",
                "a \u00b6 b\u00b6c \u00b6", "\u0301 \u200b x\x00y \x07")
    for n in (40, 400, 3000):
        yield "".join(rng.choice(pool) for _ in range(n))            # without white space
        yield "".join(rng.choice(pool + "    \n") for _ in range(n))
    yield "the" * 3000
    yield "''s" * 500 + "é" * 700
    yield "中" * 900 + "ab cd " * 900


@pytest.mark.parametrize("settings", [bpe.Settings(), bpe.Settings(words=False), bpe.Settings(leaf=37, window=4),
                                      bpe.Settings(leaf=256, window=16), bpe.Settings(leaf=64, spread=300), bpe.Settings(leaf=50, spread=50)])
def test_encoding_equals_the_library(documents, settings):
    pairs = [(i, t) for i, t in enumerate(texts())]
    got = bpe.encode(documents(pairs), ["doc_id"], settings).collect()
    assert len(got) == len(pairs)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(dict(pairs)[r.doc_id])
        assert list(r.ids) == LIB.encode(dict(pairs)[r.doc_id] or "", add_special_tokens=False).ids


def test_joining_halves_at_every_cut():
    tok = bpe.tokenizer("word_bpe_49k.json")
    s = bpe.Settings(window=3, agree=2)
    for text in ("unbelievableness'stheatre étude 12's ''s!!'re", "thththethathetionble" * 4):
        for cut in range(1, len(text)):
            left, right = bpe.encode_piece(tok, text, 0, cut), bpe.encode_piece(tok, text, cut, len(text))
            assert bpe.join_pieces(tok, text, left, right, s).ids.tolist() == LIB.encode(text, add_special_tokens=False).ids


def test_repeated_long_rows_and_null_ids_stay_rows(documents):
    long = "word " * 200
    docs = documents([(1, long), (1, long), (None, long), (2, long)])
    got = bpe.encode(docs, ["doc_id", "kept", "lang"], bpe.Settings(leaf=64, spread=128)).collect()
    assert sorted((r.doc_id or 0, r.kept, r.n_tokens) for r in got) == [(0, "x", 200), (1, "x", 200), (1, "x", 200), (2, "x", 200)]
    assert bpe.encode(documents([]), ["doc_id"]).count() == 0


def test_copies_of_a_long_text_are_encoded_once(documents):
    text = "".join(random.Random(1).choice("abcdest ") for _ in range(40_000))
    docs = documents([(k, text) for k in range(50)])
    got = bpe.encode(docs, ["doc_id"], bpe.Settings(leaf=512, spread=4096), with_ids=False)
    plan = got._jdf.queryExecution().toString()
    assert "ids" not in got.columns and "first(text" in plan
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == list(range(50))
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == {expected(text)}


def test_decode(documents):
    coded = bpe.encode(documents([(1, "Some words"), (2, None)]), ["doc_id"])
    got = {r.doc_id: r.decoded for r in bpe.decode(coded, F.col("ids")).collect()}
    assert got == {1: LIB.decode(LIB.encode("Some words", add_special_tokens=False).ids, skip_special_tokens=False), 2: ""}
