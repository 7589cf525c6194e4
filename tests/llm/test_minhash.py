import random

import numpy as np
import pytest
from llm_util import empty_docs, odd_docs, sentence, shingles

from addrflow.llm import minhash as M


def brute(rows):
    """(id, n_shingles, component_id, kept) of each row."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                up[top(i)] = top(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(top(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def families(seed, count, copies):
    """Texts edited again and again: links near the threshold, and components that are chains."""
    rng = random.Random(seed)
    rows = []
    for family in range(count):
        words = sentence(rng, rng.choice([8, 40, 90, 300])).split(" ")
        for k in range(copies):
            rows.append((1000 * family + k, " ".join(words)))
            base = words if rng.random() < 0.5 else rows[-1 - rng.randrange(min(k + 1, 6))][1].split(" ")
            words = list(base)
            for _ in range(max(1, len(words) // 75)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(9999)}"
    rng.shuffle(rows)
    return rows


def test_odd_documents_equal_brute_force(spark):
    rows, docs = odd_docs(spark)
    assert got(M.link(docs)) == brute(rows)


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 4)])
def test_chains_of_edits_equal_brute_force(spark, seed, block):
    rows = families(seed, 6, 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(M.link(docs, block=block)) == brute(rows)


def test_empty_table(spark):
    assert M.link(empty_docs(spark)).collect() == []
    assert got(M.link(spark.createDataFrame([(1, None), (1, " "), (None, "")], "doc_id long, text string"))) == sorted([(1, 0, 1, True), (1, 0, 1, True), (None, 0, None, True)], key=str)


def test_values_agree_with_the_probability_of_the_similarity():
    rng = np.random.default_rng(5)
    share = []
    for _ in range(150):
        a = rng.integers(0, 2**63, 200).astype(np.uint64)
        b = np.concatenate([a[:160], rng.integers(0, 2**63, 40).astype(np.uint64)])
        x, y = M.min_max(np.sort(a)), M.min_max(np.sort(b))
        share.append((x == y).mean())
    assert abs(np.mean(share) - 160 / 240) < 0.01
    # No more than the variance of as many independent minima, with room for chance.
    assert np.var(share) < 1.4 * (160 / 240) * (80 / 240) / (2 * M.HASHES)


def test_sets_at_the_threshold_share_a_band():
    rng = np.random.default_rng(6)
    for n in [7, 9, 20, 64, 300, 3000]:
        for _ in range(30):
            both = n * 85 // 100 + (n * 85 % 100 > 0)
            x = rng.integers(0, 2**63, n).astype(np.uint64)
            cut = both + (n - both) // 2
            a, b = np.sort(x[:cut]), np.sort(np.concatenate([x[:both], x[cut:]]))
            assert M.alike(a, [b])[0]
            assert (M.bands(M.min_max(a)) == M.bands(M.min_max(b))).any()


def test_joining_links_are_no_more_than_needed():
    """Sets of one chain in many components: a forest of links, whatever the number of pairs."""
    base = np.arange(1000, 1200).astype(np.uint64) << np.uint64(40)
    sets = [np.sort(np.concatenate([base[i:], base[:i] + np.uint64(7)])) for i in range(40)]
    keys = np.full((40, 3), 5, np.uint64)
    links = M.joining(np.uint64(5), np.ones(40, bool), np.ones(40, bool), np.arange(40), keys, sets)
    assert len(links) == 39
    assert M.joining(np.uint64(6), np.ones(40, bool), np.ones(40, bool), np.arange(40), keys, sets) == []
