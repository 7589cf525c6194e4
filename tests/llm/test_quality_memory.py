import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from addrflow.llm import quality as Q


@pytest.fixture
def rated(monkeypatch):
    """Documents with the toxic words of their grade, an empty and a null one, some rated twice."""
    monkeypatch.setattr(Q, "STEPS", 64)
    rng = np.random.default_rng(4)
    words = np.array([f"{x:x}w".translate(str.maketrans("0123456789", "ghijklmnop")) for x in rng.integers(1 << 40, size=30_000)])
    grades = rng.integers(0, Q.GRADES, 1_500)
    texts = [" ".join([*rng.choice(words, 400), *rng.choice(words[100 * g : 100 * g + 20], 10)]) for g in grades]
    texts[3], texts[4] = None, ""
    rows = [(int(h), int(g), t) for h, g, t in zip(rng.permutation(len(texts)), grades, texts, strict=True)]
    rows += rows[:20]
    return pa.table(
        {
            "doc": pa.array(rng.permutation(len(rows)), pa.int64()),
            "h": pa.array([r[0] for r in rows], pa.int64()),
            "grade": pa.array([r[1] for r in rows], pa.int32()),
            "text": pa.array([r[2] for r in rows], pa.string()),
        }
    )


def _peak(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _slices(rated):
    t = pa.Table.from_batches(Q._rows(iter(rated.to_batches(max_chunksize=400))))
    return [t.filter(pc.equal(t["slice"], k)) for k in range(Q.SLICES)]


def test_ranges_of_keys_give_the_model_of_all_keys(rated):
    picked = pa.concat_tables([Q._pick(t) for t in _slices(rated)])
    dealt = picked.take(pa.array(np.random.default_rng(1).permutation(len(picked))))
    (got,) = Q._fit(iter(dealt.combine_chunks().to_batches(max_chunksize=700)))
    found = list(Q.features(rated["text"].combine_chunks()))
    order = sorted(range(len(found)), key=lambda i: (rated["h"][i].as_py(), rated["grade"][i].as_py()))
    want = Q.fit(np.array([rated["grade"][i].as_py() for i in order]), [found[i] for i in order])
    assert len(want.keys) > 20
    for name, x in (("keys", want.keys.astype("<u8")), ("weights", want.weights), ("thresholds", want.thresholds)):
        assert got.column(name)[0].as_py() == x.tobytes()


def test_no_task_holds_the_keys_of_the_sample_more_than_once(rated):
    slices = _slices(rated)
    size = sum(t["keys"].nbytes for t in slices)
    assert size > 10e6
    picked, peaks = zip(*[_peak(lambda t=t: Q._pick(t)) for t in slices], strict=True)
    batches = pa.concat_tables(picked).to_batches()
    _, last = _peak(lambda: list(Q._fit(iter(batches))))
    assert max(*peaks, last) < size


def test_no_ratings_give_no_row():
    assert list(Q._fit(iter([]))) == []
