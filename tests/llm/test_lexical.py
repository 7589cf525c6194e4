import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_util import empty_docs, odd_docs

from addrflow.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, score long, rank int, row string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k=10):
    held = [Counter(terms(t)) for _, t in rows]
    N = sum(1 for c in held if c)
    L_ = sum(sum(c.values()) for c in held)
    df = Counter(x for c in held for x in c)
    out = []
    for item_id, text in items:
        found = []
        for (doc, _), c in zip(rows, held, strict=True):
            n, score = sum(c.values()), 0
            if not n:
                continue
            m = 100 - 75 + (75 * n * N) // L_
            for t, q in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                    score += q * w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item_id, rank, None if null else doc, -score) for rank, (score, null, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def asked(rows):
    texts = [t for _, t in rows]
    return [
        (5, texts[7]), (5, texts[7]), (None, texts[12]), (1, None), (2, ""), (3, " .,; "), (4, "w1x w1x W1X w2x w3x zzz"),
        (6, "ÀÉ日本語🙂 don't ½"), (7, "w5x " * 3000), (8, texts[16]), (9, "tail Other else"), (10, "passage of nothing known"),
    ]


@pytest.mark.parametrize("pass_terms,tile_rows", [(1 << 20, 512), (50, 3)])
def test_odd_documents_equal_brute_force(spark, pass_terms, tile_rows):
    rows, docs = odd_docs(spark)
    items = asked(rows)
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in items], ITEMS)
    assert got(L.search(docs, df, pass_terms=pass_terms, tile_rows=tile_rows)) == brute(rows, items)


def test_ties_go_by_id(spark):
    rows = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (7, "same words here"), (99, "other")]
    items = [(1, "words"), (2, "here same same")]
    df = L.search(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), tile_rows=4)
    assert got(df) == brute(rows, items)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    rows, docs = odd_docs(spark)
    assert L.search(empty_docs(spark), items).collect() == []
    assert L.search(docs, none).collect() == []
    assert L.search(spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string"), items).collect() == []


def test_tiles_keep_products_exact():
    """Counts beyond the bound of one tile come in several; sums equal those of integers."""
    rng = np.random.default_rng(3)
    most = 1 << 36
    item, col = np.nonzero(rng.random((5, 40)) < 0.5)
    count = rng.integers(1, 1 << 18, len(item))
    tiles = L.Tiles(5, item, col, count, most, columns=7)
    for _, counts in tiles.tiles:
        assert counts.shape[1] <= 7
        assert (counts.sum(1) * most < 2**53).all()
    impacts = rng.integers(0, most, (9, 40))
    dense = np.zeros((5, 40), np.int64)
    dense[item, col] = count
    assert (tiles.scores(impacts.astype(float)) == dense @ impacts.T).all()
