import os
import sys

import pytest
from llm_util import near_classes, odd_docs

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from addrflow.llm._io import stage  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_stage_on_its_predecessor(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    found = {}
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SF), name)
        found[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    kept = [(r.doc_id, r.text) for r in found["exact_dedup"]]
    want = sorted({c for _, n, c in near_classes(kept) if n} | {d for d, n, _ in near_classes(kept) if not n})
    assert sorted(r.doc_id for r in found["near_dedup"]) == want
    assert {r.doc_id for r in found["mixing"]} == set(want)
    read = {}
    for r in found["packing"]:
        read[r.doc_id] = read.get(r.doc_id, 0) + (r.start == 0)
    times = {}
    for r in found["mixing"]:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert read == times


@pytest.mark.parametrize("stage_no", range(4))
def test_stages_take_odd_and_empty_documents(spark, stage_no):
    name, apply = corpus_pipeline.STAGES[stage_no]
    rows, docs = odd_docs(spark)
    out = apply(spark, docs, SF)
    assert out.columns == docs.columns and out.count() >= 1
    assert apply(spark, docs.limit(0), SF).count() == 0
