"""Token ids against the tokenizer library; decoding is an exact round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from answerloom.llm.bpe import Codec, decode_ids, encode_texts, parse_ranks, round_trip, token_count
from answerloom.llm.queries import tokenizer


@pytest.fixture(scope="module")
def pair():
    blob, pattern = tokenizer()
    ranks = parse_ranks(blob)
    return Codec(ranks, pattern), tiktoken.Encoding(
        "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_texts_of_all_kinds(pair):
    own, library = pair
    rng = random.Random(4)
    texts = ["", " ", "a", "don't I'LL 've", "x" * 2500, "äöü" * 500, "的人" * 400, "1234567890" * 90, "\n\n \t x ",
             " " * 3000 + "a", "<|endoftext|>", "🙂" * 50, "a\x1cb \x85 c  d﻿"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF)])) for _ in range(60)) for _ in range(300)]
    got = own.encode(texts)
    assert got == [packed(library.encode_ordinary(t)) for t in texts]
    assert own.decode(got) == [t.encode() for t in texts]


def test_every_assigned_plane_splits_alike(pair):
    own, library = pair
    chars = [chr(x) for x in range(0, 0x3000) if not 0xD800 <= x < 0xE000]
    texts = [f"a{c}b {c}{c}1{c} {c}" for c in chars]
    assert own.encode(texts) == [packed(library.encode_ordinary(t)) for t in texts]


def test_forgetting_words_changes_nothing(pair, monkeypatch):
    own, library = pair
    monkeypatch.setattr("answerloom.llm.bpe.REMEMBERED", 10)
    monkeypatch.setattr("answerloom.llm.bpe.PILE", 40)
    monkeypatch.setattr("answerloom.llm.bpe.DECODE_TOKENS", 7)
    texts = ["some words that come again and again, some notatokenatall"] * 5 + ["unbelievablyish " * 30]
    fresh = Codec(own.ranks, public_tokenizers.PATTERN)
    got = [x for t in texts for x in fresh.encode([t])]
    assert got == [packed(library.encode_ordinary(t)) for t in texts]
    assert fresh.decode(got) == [t.encode() for t in texts]


def test_frames(spark, make_docs, clashing, pair):
    blob, pattern = tokenizer()
    rows = [(1, None), (2, ""), (3, "two words"), (3, "two words"), (None, "é" * 30_000)]
    df = make_docs(rows).withColumns({c: F.lit(c) for c in [*clashing, "token_ids", "decoded"]})
    coded = encode_texts(df, blob, pattern)
    ids = coded.columns[-1]
    out = decode_ids(coded, blob, pattern, ids).withColumn("n", token_count(ids))
    assert ids == "_token_ids"
    got = sorted((r["doc_id"] or 0, bytes(r["_decoded"]).decode(), r["n"]) for r in out.collect())
    want = sorted((i or 0, t or "", len(pair[1].encode_ordinary(t or ""))) for i, t in rows)
    assert got == want
    assert encode_texts(make_docs([]), blob, pattern).collect() == []


def test_one_worker_encodes_and_decodes(spark, make_docs, clashing):
    blob, pattern = tokenizer()
    rows = [(1, None), (2, ""), (3, "two words"), (3, "two words"), (None, "é" * 30)]
    df = make_docs(rows).withColumns({c: F.lit(c) for c in [*clashing, "token_ids", "both"]})
    apart = decode_ids(encode_texts(df, blob, pattern), blob, pattern, "_token_ids")
    out = round_trip(df, blob, pattern)
    assert out.columns == apart.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, apart.collect()))
    plan = out.select("_token_ids", "decoded")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("code(") == 1
    assert round_trip(make_docs([]), blob, pattern).collect() == []
