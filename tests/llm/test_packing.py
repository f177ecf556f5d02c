"""Tokens against the tokenizer itself, gapless sequences, bounds against exhaustive packing."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm.packing import WordIds, best_fit_decreasing, lower_bound, pack_documents, pack_pieces, token_pieces
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(FILE)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def expected_pieces(docs, capacity=4096):
    out = []
    for doc_id, text in docs:
        ids = ids_of(text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            out.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=repr)


def check_sequences(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op2_best_fit_packing"](spark, SF).collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=repr) == expected_pieces(docs)
    used = check_sequences(rows, 4096)
    assert used == lower_bound(np.array([r.length for r in rows]), 4096) and all(r.certified for r in rows)


PIECES = ["<|endoftext|>", "<|ENDOFTEXT|>", "don't", "it's.", "A.B", "x!!", "\u0130", "\u03a3.", "e\u0301,", ".", "\u0308", "12.5", "\n", " ", "ok"]


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60) | st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_ids_by_parts_are_those_of_the_text(text):
    ids, bounds = _encoder().encode([text, "a " + text + "\n\nb"])
    assert ids[: bounds[1]].tolist() == ids_of(text)[:-1]
    assert ids[bounds[1] :].tolist() == ids_of("a " + text + "\n\nb")[:-1]


def test_all_letters_with_each_stop():
    """Letters that fall apart into marks take the stop behind them into one token."""
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalnum()]
    for stop in ".,!?":
        texts = [c + stop for c in letters] + [f"a{c}{stop}" for c in letters]
        expected = [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
        encoder = _encoder()
        for at in range(0, len(texts), 50_000):
            ids, bounds = encoder.encode(texts[at : at + 50_000])
            got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            assert got == expected[at : at + 50_000]


_KEPT = []


def _encoder():
    if not _KEPT:
        with open(FILE, encoding="utf-8") as f:
            _KEPT.append(WordIds(f.read(), most=9000))
    return _KEPT[0]


def exact_bins(lengths, capacity):
    for k in range(1, len(lengths) + 1):
        for deal in itertools.product(range(k), repeat=len(lengths)):
            if max(np.bincount(deal, lengths, k)) <= capacity:
                return k
    return 0


@pytest.mark.parametrize("seed", range(12))
def test_bounds_hold(seed):
    random.seed(seed)
    lengths = np.array([random.randint(1, 20) for _ in range(7)])
    bins, offsets = best_fit_decreasing(lengths, 20)
    assert lower_bound(lengths, 20) <= exact_bins(lengths.tolist(), 20) <= bins.max() + 1
    assert (offsets + lengths <= 20).all()
    assert lower_bound(np.array([11] * 5), 20) == 5 and lower_bound(np.array([7] * 6), 20) == 3


def test_groups_exchange_what_does_not_fit(spark):
    random.seed(1)
    rows = [(i, 0, 0, random.choice([random.randint(1, 99), random.randint(30, 70)]), i, random.getrandbits(31)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, deal long")
    got = pack_pieces(df, capacity=100, group_pieces=1000).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(r[0], r[3]) for r in rows]
    used, needed = check_sequences(got, 100), lower_bound(np.array([r[3] for r in rows]), 100)
    assert needed <= used <= needed * 1.015


def test_dealing_goes_on_while_it_gains(spark):
    """More rounds than one worker could foresee, and never more sequences than the first round gave."""
    random.seed(7)
    rows = [(i, 0, 0, random.randint(34, 66), i, random.getrandbits(31)) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, deal long")
    got = pack_pieces(df, capacity=100, group_pieces=25).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(r[0], r[3]) for r in rows]
    assert check_sequences(got, 100) <= len(rows) * 0.62


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a"), (4, "a"), (None, "b c"), (5, "word " * 9000), (6, "x" * 30_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int")
    got = pack_documents(df, FILE).collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=repr) == expected_pieces(rows)
    check_sequences(got, 4096)
    assert pack_documents(df.limit(0), FILE).collect() == []
    kept = token_pieces(df, FILE, keep_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in kept)
