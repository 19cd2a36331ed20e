import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL
from tests.llm import brute
from watchfold.llm import bpe
from watchfold.llm.common import table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
CODER = bpe.Coder(RANKS, public_tokenizers.PATTERN)
LIB = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = st.text(st.sampled_from("ab' \n\t\xa0 rse'tvl1٣²éß€ǅ語\U0001f600\x1c\x85_-#"), max_size=120)


@pytest.fixture
def short_leaves(monkeypatch):
    monkeypatch.setattr(bpe, "TEXT_LEAF", 3)
    monkeypatch.setattr(bpe, "PIECE_LEAF", 2)
    CODER.clear()
    yield
    CODER.clear()


def test_every_token_is_its_own_encoding():
    assert all(CODER.merged(b) == [i] for b, i in RANKS.items() if len(b) > 1)


def test_every_character():
    for low in range(0, 0x110000, 0x800):
        chars = [chr(c) for c in range(low, low + 0x800) if not 0xD800 <= c < 0xE000]
        text = "a" + " x".join(f"{c}b{c} {c}" for c in chars)
        assert CODER.encode(text) == LIB.encode_ordinary(text), hex(low)


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_halves_equal_the_library(text):
    leaf, piece = bpe.TEXT_LEAF, bpe.PIECE_LEAF
    bpe.TEXT_LEAF, bpe.PIECE_LEAF = 3, 2
    try:
        CODER.clear()
        ids = CODER.encode(text)
        assert ids == LIB.encode_ordinary(text)
        assert CODER.decode(ids) == text.encode()
    finally:
        bpe.TEXT_LEAF, bpe.PIECE_LEAF = leaf, piece


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abetion"), min_size=100, max_size=400))
def test_long_pieces_equal_the_library(text):
    assert CODER.encode(text) == LIB.encode_ordinary(text)


def test_whole_table_and_odd_rows(spark):
    texts = [None, "", "<|endoftext|>", "a" * 30_000, "ab " * 30_000, " " * 20_000, "\n\n  x", "1" * 999, "'re" * 9000]
    docs = table(spark, SMALL, "documents")
    docs = docs.unionByName(brute.documents(spark, texts).selectExpr("doc_id - 100 doc_id", "text", "lang", "source", "n_chars"))
    got = {r.doc_id: r for r in bpe.digests(docs).collect()}
    for d in docs.collect():
        ids = LIB.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    assert bpe.digests(brute.documents(spark, [])).count() == 0


def test_other_columns_stay(spark):
    docs = brute.documents(spark, ["a b", None], [(1, "a b", "x", "y", 2), (1, "a b", "x", "y", 2)])
    out = bpe.encode(docs.withColumnRenamed("lang", "token_ids").withColumnRenamed("source", "whole"))
    assert sorted(out.columns) == sorted(["doc_id", "text", "whole", "n_chars", "token_ids"]) and out.count() == 4
