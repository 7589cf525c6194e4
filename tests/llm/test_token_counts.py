import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_util import empty_docs, odd_docs
from tokenizers import Tokenizer

from addrflow.llm import token_counts as T

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
COUNTER = T.Counter(PATH)


def n_tokens(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("chunk", [32 << 20, 2000])
def test_odd_documents_equal_the_library(spark, monkeypatch, chunk):
    monkeypatch.setattr(T, "CHUNK_BYTES", chunk)
    rows, docs = odd_docs(spark)
    rows = rows + [(777, "Orre " * 70_000)]
    docs = docs.unionByName(spark.createDataFrame(rows[-1:], "doc_id long, text string"), allowMissingColumns=True)
    got = T.count(docs, PATH, limit=100).collect()
    want = [(d, len((t or "").encode()), n_tokens(t), n_tokens(t) > 100) for d, t in rows]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert T.count(empty_docs(spark), PATH).collect() == []


PARTS = ["don't", "I'LL", "<|endoftext|>", "<|start", "\x1c", "\x1f", "\x85", "\u00a0", "\u3000", " ", "\n", "Σ", "ΟΔΟΣ", "İ", "ﬁ", "½²", "e\u0301", "\u0301", "\u00ad", "日本", "🙂", "ǅ", "ß", "12a", "...", "'s", "ſ", "K", "\u200b", "a_b"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=12).map("".join))
def test_units_count_like_the_library(text):
    assert sum(COUNTER[u] for u in T.units(text)) == n_tokens(text)
