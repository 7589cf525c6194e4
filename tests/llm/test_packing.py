import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_util import empty_docs, odd_docs
from tokenizers import Tokenizer

from addrflow.llm import packing as P
from addrflow.llm._tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def _pieces(rows, size):
    out = []
    for d, t in rows:
        x, at, k = ids(t), 0, 0
        while at < len(x):
            stop = at + ((len(x) - at) % size or size)
            out.append((d, k, at, stop - at, zlib.crc32(np.array(x[at:stop], "<u4").tobytes())))
            at, k = stop, k + 1
    return sorted(out, key=str)


def _check(got, rows, size):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == _pieces(rows, size)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= size
    return len(bins)


@pytest.mark.parametrize("items", [P.ITEMS, 7])
def test_odd_documents_round_trip(spark, items):
    rows, docs = odd_docs(spark)
    for size in (P.SIZE, 64):
        n = _check(P.pack(docs, PATH, size=size, items=items).collect(), rows, size)
        total = sum(len(ids(t)) for _, t in rows)
        assert n <= 1.25 * -(-total // size) + 2


def test_empty_table(spark):
    assert P.pack(empty_docs(spark), PATH).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80))
def test_best_fit(lengths):
    bins = P.best_fit(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    sums = [sum(lengths[i] for i in b) for b in bins]
    assert all(s <= 100 for s in sums)
    assert sum(2 * s <= 100 for s in sums) <= 1
    assert len(bins) <= 1.25 * -(-sum(lengths) // 100) + sum(n > 50 for n in lengths) + 1


PARTS = [" ", "  ", "   ", "\n", "\n\n", "\t", " \n", "word", "Word,", "don't", "12", "<|endoftext|>", "<|end", "\x1c", "\u00a0", "é", "日本", "🙂", "½", "''", "\r\n", "\x85"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=3)), max_size=14).map("".join))
def test_units_encode_like_the_library(text):
    assert ENCODER.ids(text) == np.array(ids(text)[:-1], "<u4").tobytes()


def _plain_best_fit(lengths, size):
    """Number of bins: each item, longest first, into the fullest bin that takes it."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(size - n)
    return len(rooms)


def test_number_of_sequences_is_that_of_best_fit(spark):
    """One node packs as plain best-fit does; a tree of many nodes needs at most 3 % more."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    least = _plain_best_fit([p[3] for p in _pieces(rows, P.SIZE)], P.SIZE)
    assert _check(P.pack(docs, PATH).collect(), rows, P.SIZE) == least
    assert _check(P.pack(docs, PATH, items=40).collect(), rows, P.SIZE) <= 1.03 * least + 1


@pytest.mark.parametrize("text", ["日本語" * 30_000, "ไทย" * 20_000, "x" * 100_000, "héé" * 20_000, "1" * 30_000, "a.b," * 20_000])
def test_long_texts_without_spaces(text):
    """Encoded like the library does, and not kept in the memo."""
    enc = Encoder(PATH)
    assert enc.ids("a " + text) == np.array(ids("a " + text)[:-1], "<u4").tobytes()
    assert all(len(u) <= 256 for memo in (enc.first, enc.later) for u in memo)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abzAZéÀÿſ.,;:!?()[]{}_-'\"~1", min_size=1, max_size=8), max_size=6).map(" ".join))
def test_words_with_marks_encode_like_the_library(text):
    assert ENCODER.ids(text) == np.array(ids(text)[:-1], "<u4").tobytes()
