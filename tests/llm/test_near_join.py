import random

import numpy as np
import pytest
from llm_util import empty_docs, near_classes, odd_docs, sentence, shingles

from addrflow.llm import near_join as N


def _rows(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id is None, r.component_id or 0) for r in df.collect())


def _want(rows):
    return sorted((d is None, d or 0, n, c is None, c or 0) for d, n, c in near_classes(rows))


def test_odd_documents_equal_brute_force(spark):
    rows, docs = odd_docs(spark)
    assert _rows(N.link(docs)) == _want(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_edits_equal_brute_force(spark, seed):
    """Texts edited again and again: links near the threshold, and components that are chains."""
    rng = random.Random(seed)
    rows = []
    for family in range(6):
        words = sentence(rng, rng.choice([8, 25, 90, 300])).split(" ")
        for k in range(14):
            rows.append((1000 * family + k, " ".join(words)))
            base = words if rng.random() < 0.6 else list(rows[-1 - rng.randrange(min(k + 1, 5))][1].split(" "))
            words = list(base)
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(9999)}"
            if rng.random() < 0.3:
                words += sentence(rng, max(1, len(words) // 20)).split(" ")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _rows(N.link(docs)) == _want(rows)


def test_one_of_each_keeps_the_smallest_id_and_all_columns(spark):
    rows, docs = odd_docs(spark)
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = near_classes(rows)
    want = {c for _, n, c in classes if n and c is not None}
    got = [r.doc_id for r in kept.collect() if shingles(r.text)]
    assert sorted(got) == sorted(want)
    empty = [d for d, n, _ in classes if not n]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect() if not shingles(r.text)) == sorted((d is None, d or 0) for d in empty)


def test_empty_table(spark):
    assert N.link(empty_docs(spark)).collect() == []
    assert N.one_of_each(empty_docs(spark)).collect() == []


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for n in [4, 5, 6, 9, 12, 20, 37, 64, 100, 333, 1000, 2500]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            # The most elements that a linked set may miss or have besides.
            out = [(k, m) for k in range(n) for m in range(n) if 100 * (n - k) >= 80 * (n + m)]
            k, m = out[rng.integers(len(out))] if rng.random() < 0.5 else max(out, key=lambda x: (x[0] + x[1], rng.random()))
            b = np.union1d(rng.permutation(a)[k:], rng.integers(0, 2**63, m).astype(np.uint64))
            same = len(np.setxor1d(a, b)) == 0
            assert same or len(np.intersect1d(N.signatures(a), N.signatures(b)))


def test_sketches_never_exceed_the_distance():
    rng = np.random.default_rng(2)
    for n, m in [(5, 6), (70, 60), (127, 130), (500, 520)]:
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.union1d(a[: len(a) * 9 // 10], rng.integers(0, 2**63, max(0, m - n * 9 // 10)).astype(np.uint64))
        x, y = N._sketch(a), N._sketch(b)
        w = min(len(x), len(y))
        x, y = (np.bitwise_xor.reduce(v.reshape(-1, w), 0) for v in (x, y))
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))
