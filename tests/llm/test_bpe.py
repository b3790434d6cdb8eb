"""Encoding against the tokenizer's own library, and the round trip."""

import base64
import random

import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from civicspark.llm import bpe  # noqa: E402

TEXTS = [
    "", " ", "\n\n  x ", "Olá, mundo! It's 2024's", "a" * 3000, " " * 500, "=" * 777, "日本語テキスト", "naïve café ½ ﬁ", "<|endoftext|> x", "a\tb\r\n", "👩‍👩‍👧 é́", "  x­", "x" * 40_000,
    "".join(random.Random(1).choice("abcdefgh") for _ in range(2500)), "palavra " * 5000, "\x00\x01﻿",
]


def reference(path):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_same_as_library(name):
    ref = reference(P.path(name.replace(".json", ".tiktoken")))
    enc = bpe.Encoder(P.path(name))
    for t, ids in zip(TEXTS, enc.encode(TEXTS)):
        assert ids == ref.encode_ordinary(t), t[:30]
        assert enc.decode(ids) == t


def test_long_words():
    r = random.Random(2)
    enc = bpe.Encoder(P.path("byte_bpe_50k.json"))
    ref = reference(P.path("byte_bpe_50k.tiktoken"))
    for t in ("".join(r.choice("abcdefghijklmnop") for _ in range(30_000)), "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(8_000)), "ab" * 5_000, "a" * 9_999):
        assert enc.encode([t])[0] == ref.encode_ordinary(t)
        assert enc.decode(enc.encode([t])[0]) == t


def test_words_are_cut_where_no_merge_crosses():
    enc = bpe.Encoder(P.path("byte_bpe_50k.json"))
    assert all(enc.joined[a, b] for t in enc.ids for a, b in zip(t, t[1:]))
    assert not enc.joined.all()


def test_table(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "abc", "x"), (None, "abc", "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = [(r.doc_id, r.ids) for r in bpe.encoded(df).collect()]
    abc = bpe.encoder().encode(["abc"])[0]
    assert sorted(got, key=str) == sorted([(1, []), (2, []), (2, abc), (None, abc)], key=str)
    assert bpe.encoded(df.limit(0)).count() == 0
    back = bpe.decoded(bpe.encoded(df)).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted([(1, ""), (2, ""), (2, "abc"), (None, "abc")], key=str)
    assert {r.n_tokens for r in bpe.token_counts(df, ["doc_id", "ids"]).collect()} == {0, len(abc)}


def test_whole_table(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    ref = reference(P.path("byte_bpe_50k.tiktoken"))
    got = {r.doc_id: r.ids for r in bpe.encoded(df).collect()}
    for r in df.collect():
        assert got[r.doc_id] == (ref.encode_ordinary(r.text) if r.text else [])
