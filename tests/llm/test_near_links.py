import random
from collections import Counter, defaultdict

import pytest
from llm_util import empty_docs, odd_docs, sentence, shingles

from addrflow.llm import near_join as N


def _want(rows):
    """(links, counts): ((id, id), (rows, rows)) of linked classes, and id -> (rows, links of a row)."""
    least, size = {}, Counter()
    for d, t in rows:
        s = shingles(t)
        if s:
            size[s] += 1
            least[s] = d if least.get(s) is None else least[s] if d is None else min(least[s], d)
    found, counts = Counter(), defaultdict(int)
    sets = list(size)
    for i, a in enumerate(sets):
        for b in sets[: i + 1]:
            if 100 * len(a & b) >= 80 * len(a | b) and (a != b or size[a] > 1):
                found[frozenset([(least[a], size[a]), (least[b], size[b])])] += 1
                counts[a] += size[b] - (a == b)
                if a != b:
                    counts[b] += size[a]
    return found, Counter((least[s], size[s], k) for s, k in counts.items())


def _check(rows, docs, **how):
    links = N.class_links(docs, **how)
    want, counts = _want(rows)
    got = links.collect()
    assert Counter(frozenset([(r.a_id, r.a_rows), (r.b_id, r.b_rows)]) for r in got) == want and got
    assert Counter((r.id, r.rows, r.links) for r in N.link_counts(links).collect()) == counts


def test_odd_documents_equal_brute_force(spark):
    _check(*odd_docs(spark))


@pytest.mark.parametrize("block_rows", [512, 3])
def test_links_inside_components_equal_brute_force(spark, block_rows):
    """A family in which nearly all pairs link: more links than its component needs."""
    rng = random.Random(9)
    rows = []
    for family in range(2):
        base = sentence(rng, 150 + 60 * family).split(" ")
        for k in range(16):
            words = list(base)
            for _ in range(k % 3):
                words[rng.randrange(len(words))] = f"new{rng.randrange(9999)}"
            rows.append((100 * family + k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    _check(rows, docs, block_rows=block_rows)


def test_empty_table(spark):
    assert N.class_links(empty_docs(spark)).collect() == []
