"""Rows of the pipeline's stages against versions that work row by row, each on the stage's own input."""

import os
import sys
from collections import Counter

import pyarrow as pa
from llm_util import near_classes
from test_mixing import _want as readings

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from addrflow.llm import quality  # noqa: E402
from addrflow.llm._io import stage  # noqa: E402

SF = "/root/testdata/sf0.001"
SPACE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def _rows(rows):
    return Counter(tuple(r) for r in rows)


def test_rows_of_every_selecting_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit_on(docs, labels)
    found = [docs.collect()]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = stage(apply(spark, docs, SF), name)
        found.append(docs.collect())
    raw, selected, unique, apart, mixed = found

    tails = model.tails([model.score(x) for x in quality.features(pa.array([r.text for r in raw], pa.string()))])
    assert _rows(selected) == _rows(r for r, t in zip(raw, tails, strict=True) if t[-1] >= quality.KEEP)
    clean = {r.doc_id for r in labels.filter("quality = 1 and toxic = 0").collect()} & {r.doc_id for r in raw}
    assert len(clean & {r.doc_id for r in selected}) >= 0.95 * len(clean) > 0

    groups = {}
    for r in selected:
        groups.setdefault((r.text or "").translate(SPACE), []).append(r)
    assert _rows(unique) == _rows(min(g, key=lambda r: (-len(r.text or ""), r.doc_id)) for g in groups.values())

    near = near_classes([(r.doc_id, r.text) for r in unique])
    stay = {c if n else d for d, n, c in near}
    assert _rows(apart) == _rows(r for r in unique if r.doc_id in stay)

    _, want = readings([(r.doc_id, r.source, r.text) for r in apart], corpus_pipeline.MAX_EPOCHS, 4096)
    got = Counter((r.doc_id, "n" if r.source is None else "s" + r.source) for r in mixed)
    # The exponent is found to six places, so a budget may differ by a token at its edge.
    assert set(_rows(mixed)) == set(_rows(apart)) and sum(abs(got[k] - want[k]) for k in got | want) <= 4
