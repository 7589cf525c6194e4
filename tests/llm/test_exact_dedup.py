import hashlib
import re

import pytest
from llm_util import empty_docs, odd_docs

from addrflow.llm import exact_dedup as X


def _normal(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def _want(rows):
    groups: dict = {}
    for d, t in rows:
        groups.setdefault(_normal(t), []).append((-len(t or ""), d is None, d or 0))
    out = []
    for d, t in rows:
        own = groups[_normal(t)]
        best = min(own)
        out.append((d, None if best[1] else best[2], len(own), hashlib.sha256(_normal(t).encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("heavy", [True, False])
def test_odd_documents_equal_brute_force(spark, monkeypatch, heavy):
    rows, docs = odd_docs(spark)
    rows = rows + [(500 + i, "hot  copy") for i in range(300)] + [(900, "hot copy")]
    docs = docs.unionByName(spark.createDataFrame([(d, t) for d, t in rows[-301:]], "doc_id long, text string"), allowMissingColumns=True)
    if not heavy:
        monkeypatch.setattr(X, "heavy_digests", lambda light: [])
    got = X.decide(docs).collect()
    want, groups = _want(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == groups == len({r.text_sha256 for r in got if r.kept})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_the_sketch_names_the_hot_digest(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as _h")
    assert X.heavy_digests(df) and "hot" in X.heavy_digests(df)


def test_deduplicate_keeps_columns_and_one_row_of_each(spark):
    rows, docs = odd_docs(spark)
    kept = X.deduplicate(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({_normal(t) for _, t in rows})


def test_empty_table(spark):
    assert X.decide(empty_docs(spark)).collect() == []
    assert X.deduplicate(empty_docs(spark)).collect() == []
