import math
import random

import pytest
from pyspark.sql import functions as F

from addrflow.llm import knn_join as K

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, row string"


def _rows(n=300, dim=6):
    rng = random.Random(2)
    common = [rng.gauss(0, 1) for _ in range(dim)]
    rows = [(i, common if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(1000, None), (1001, [1.0, None] + [0.0] * (dim - 2)), (1002, [math.nan] * dim), (1003, [math.inf] * dim), (1004, []), (1050, [])]
    rows += [(1100, [1.0, 2.0]), (1101, [3.0, 1.0]), (None, common), rows[50], rows[7], (1150, [1e6] * dim), (1151, [-1e6] * dim), (1200, [3e38] * dim)]
    return rows


def _want(rows, k):
    ok = []
    for i, v in rows:
        v = None if v is None else [None if x is None else float(F_(x)) for x in v]
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for n, (i, v) in enumerate(ok):
        if i % 50 == 0:
            scored = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w, strict=True)))), j) for m, (j, w) in enumerate(ok) if m != n and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def F_(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("block", [16384, 20])
def test_odd_vectors_equal_brute_force(spark, block):
    rows = _rows()
    df = spark.createDataFrame([(i, v, None, 3, "x") for i, v in rows], SCHEMA).repartition(3)
    got = K.top_k(df, F.col("vec_id") % 50 == 0, block_rows=block)
    assert sorted(tuple(r) for r in got.collect()) == _want(rows, 5)


def test_clustered_vectors_need_few_replicas_and_stay_exact(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        c = i % 8
        rows.append((i, [(20.0 if d == c else 0.0) + rng.gauss(0, 0.1) for d in range(8)]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in K.top_k(df, F.col("vec_id") % 50 == 0).collect()) == _want(rows, 5)


def test_empty_table(spark):
    assert K.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []


def test_a_hot_cell_with_most_queries_stays_exact_and_its_groups_bounded(spark, monkeypatch):
    """Nearly all vectors in one cell, and the queries that reach it: both sides in blocks."""
    rng = random.Random(4)
    rows = [(i, [1.0 + rng.gauss(0, 0.01) for _ in range(4)]) for i in range(600)]
    rows += [(10_000 + i, [30.0 * rng.choice([-1, 1]) + rng.gauss(0, 1) for _ in range(4)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    is_query = F.col("vec_id") % 2 == 0
    got = K.top_k(df, is_query, block_rows=40, max_pivots=2)
    want = {}
    ok = [(i, [math.floor(256 * F_(x)) for x in v]) for i, v in rows]
    for i, v in ok:
        if i % 2 == 0:
            want[i] = [(j, s) for s, j in sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j) for j, w in ok if j != i)[:5]]
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, -r.score))
    assert found == want


def test_vectors_without_components(spark):
    """Dimension 0: every score is 0, ties go by id."""
    df = spark.createDataFrame([(i, []) for i in range(0, 120, 10)], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in K.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got[:5] == [(0, n, 10 * n, 0) for n in range(1, 6)] and len(got) == 15
