import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from llm_util import empty_docs, odd_docs

from addrflow.llm import mixing as M


def _mark(*parts):
    return int(hashlib.md5("/".join("-" if p is None else str(p) for p in parts).encode()).hexdigest()[:12], 16)


def _want(rows, max_epochs, block_rows, seed=7):
    """Readings of each (id, source): the method, row by row. rows: (id, source, text)."""
    by = defaultdict(list)
    for d, s, t in rows:
        by["n" if s is None else "s" + s].append((d, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))))
    total = {s: sum(n for _, n in v) for s, v in by.items()}
    top = max(total.values())
    ratio = top / min(n for n in total.values() if n)
    a = 0.0 if ratio <= max_epochs else 1 - math.log(max_epochs) / math.log(ratio)
    out = Counter()
    for s, docs in by.items():
        full, left = 1, 0
        if total[s]:
            full, left = divmod(round(total[s] * (top / total[s]) ** (1 - a)), total[s])
        blocks = -(-len(docs) // block_rows)
        inside = defaultdict(list)
        for d, n in docs:
            out[d, s] += full
            inside[_mark(seed, d) % blocks].append((d, n))
        for b in sorted(inside, key=lambda b: (_mark(seed, full, s, b), b)):
            size = sum(n for _, n in inside[b])
            run = 0
            for d, n in sorted(inside[b], key=lambda x: (_mark(seed, full, x[0]), x[1])):
                run += n
                if left > 0 and (size <= left or run <= left):
                    out[d, s] += 1
            left -= size
    return a, out


@pytest.mark.parametrize("block_rows", [4096, 5])
def test_readings_equal_the_method_row_by_row(spark, block_rows):
    rng = random.Random(4)
    rows = [(i, "big" if i % 3 else f"small{i % 5}", " ".join("w" for _ in range(rng.randrange(1, 60)))) for i in range(400)]
    rows += [(1000, None, "a b"), (1001, "void", None), (1002, "void", " ")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    got = M.mix(docs, block_rows=block_rows)
    a, want = _want(rows, 2.0, block_rows)
    seen = Counter((r.doc_id, "n" if r.source is None else "s" + r.source) for r in got.select("rec.*").collect())
    budget = {s: sum(1 for (d, x), n in want.items() for _ in range(n) if x == s) for s in {s for _, s in want}}
    got_by = Counter()
    for (_, s), n in seen.items():
        got_by[s] += n
    # The exponent is found to six places, so a budget may differ by a token at its edge.
    assert sum(abs(seen[k] - want[k]) for k in seen | want) <= 4
    assert all(abs(got_by[s] - budget[s]) <= 1 for s in budget)
    assert all(n in (1, 2) for n in seen.values())
    weights = {r.source: r.weight for r in got.select("rec.source", "weight").distinct().collect()}
    assert sum(weights.values()) == pytest.approx(1, abs=1e-6)


def test_entropy_target(spark):
    rows = [(i, "ab"[i % 10 == 0], "w " * 10) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    w = [r.weight for r in M.mix(docs, max_epochs=100.0, target_entropy=0.9).select("rec.source", "weight").distinct().collect()]
    assert -sum(x * math.log(x) for x in w) / math.log(2) == pytest.approx(0.9, abs=1e-4)


def test_odd_documents_lose_no_row(spark):
    rows, docs = odd_docs(spark)
    got = M.mix(docs).select("rec.*")
    assert got.columns == docs.columns
    key = lambda r: (str(r.doc_id), str(r.text), str(r.source))
    assert set(map(key, got.collect())) == set(map(key, docs.collect()))
    assert got.count() >= len(rows)


def test_empty_table(spark):
    assert M.mix(empty_docs(spark)).collect() == []
