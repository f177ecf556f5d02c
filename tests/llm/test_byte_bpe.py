"""Byte-level BPE against the tiktoken library, and the edge cases of the docstrings."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import byte_bpe
from millrace.llm.byte_bpe import Decoder, Encoder, Vocabulary, decode_documents, encode_documents
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def pair(request):
    vocabulary = Vocabulary.read(public_tokenizers.path(request.param))
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.ids, special_tokens={})
    encoder, decoder = Encoder(vocabulary, PATTERN), Decoder(vocabulary)
    yield encoder, decoder, other
    encoder.close()
    decoder.close()


def check(pair, texts):
    encoder, decoder, other = pair
    ids, bounds = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [other.encode_ordinary(t) for t in texts]
    assert decoder.decode(ids, bounds) == [t.encode() for t in texts]


PIECES = ["the", " The", "'s", "'ll ", "\n\n", "  ", "\t", "aaaaaaa", "1234567", "日本語", "क्षत्रिय", "é", "🙂🏽", "<|endoftext|>", "\x00", "_", "...", " ", "​"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40) | st.lists(st.sampled_from(PIECES), max_size=30).map("".join), max_size=4))
def test_texts(pair, texts):
    check(pair, texts)


@settings(max_examples=60, deadline=None)
@given(st.text("aAbBcCeéо", min_size=60, max_size=400), st.text("actghe", min_size=65, max_size=900))
def test_long_words(pair, a, b):
    check(pair, [a, b, a + b])


def test_very_long_words_and_texts(pair, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WORDS", 1000)
    monkeypatch.setattr(byte_bpe, "TOKENS", 777)
    letters = np.random.default_rng(1).integers(97, 123, 20_000).astype(np.uint8).tobytes().decode()
    check(pair, ["a" * 30_000, "日本語の魔法" * 3000, "ACGTTGCA" * 2500, letters, "some of the words, " * 80_000, "", "x"])


def test_forgetting_known_words(pair, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN_BYTES", 5000)
    monkeypatch.setattr(byte_bpe, "WORDS", 50)
    check(pair, [" ".join(f"w{i * k}or{i}" for i in range(300)) for k in (3, 7)])


def test_a_merge_that_makes_a_smaller_rank_comes_next():
    """After ab (rank 258) the pair (ab, c) has the smaller rank 257, although b c a b would merge too."""
    ids = {bytes([b]): b for b in range(256)} | {b"abc": 257, b"ab": 258, b"ca": 259, b"abcab": 260}
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})
    encoder = Encoder(Vocabulary.of(ids), PATTERN)
    for text in ("abcab", "abcabcab" * 20, "cababc" * 30, "abab" * 40 + "c"):
        assert encoder.encode([text])[0].tolist() == other.encode_ordinary(text)


def test_the_query(spark):
    vocabulary = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.ids, special_tokens={})
    expected = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = other.encode_ordinary(r.text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((r.doc_id, len(ids), digest, hashlib.sha256(other.decode_bytes(ids)).hexdigest()))
    got = QUERIES["op12_byte_bpe"](spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_nulls_repeated_rows_extra_columns_and_empty_tables(spark):
    vocabulary = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = [(1, None, 5, "a"), (2, "", 6, "b"), (None, "hello  there", 7, "c"), (3, "x", 8, "d"), (3, "x", 8, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, bytes string")
    encoded = encode_documents(docs, vocabulary, PATTERN)
    assert encoded.columns == ["doc_id", "ids"]
    got = [(r.doc_id, bytes(r.bytes)) for r in decode_documents(encoded, vocabulary).collect()]
    assert sorted(got, key=str) == sorted([(1, b""), (2, b""), (None, b"hello  there"), (3, b"x"), (3, b"x")], key=str)
    assert encode_documents(docs.limit(0), vocabulary, PATTERN).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [87])], "doc_id long, ids array<int>")
    assert [r.bytes for r in decode_documents(nulls, vocabulary).orderBy("doc_id").collect()] == [None, b"x"]


@pytest.mark.parametrize("ids", [[50_256], [-1], [None]])
def test_unknown_ids(spark, ids):
    vocabulary = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = spark.createDataFrame([(1, ids)], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="an id is"):
        decode_documents(rows, vocabulary).collect()
