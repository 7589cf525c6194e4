import random
import tracemalloc

import numpy as np
import pyarrow as pa

from addrflow.llm import suffix_dedup as S


def _peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_chunk_is_cut_in_a_few_times_its_size():
    size = 1 << 22
    t = pa.table({"id": pa.array(range(size >> 12), pa.int64()), "text": ["x" * 4096] * (size >> 12)})
    none = pa.table({"doc": pa.array([], pa.binary()), "start": pa.array([], pa.binary()), "stop": pa.array([], pa.binary())})
    assert _peak(lambda: S._cut(t, none)) < 10 * size


def test_a_bucket_of_repeated_runs_takes_little_of_a_worker():
    """Runs travel with the bytes around them, so those of a bucket's windows are longer than its share of text."""
    rng = random.Random(5)
    runs = S.BUCKET_BYTES // 14  # windows of a run, as in text
    strings = [rng.randbytes(63).replace(b"\xff", b"x") for _ in range(runs // 4)]
    own = len(strings)
    row = {
        "bucket": 0, "chunk": 0, "strings": b"".join(strings), "windows": bytes([14]) * own, "which": np.arange(own, dtype="<u4").tobytes(),
        "doc": np.zeros(own, "<u4").tobytes(), "id": np.arange(own, dtype="<i8").tobytes(), "start": np.arange(own, dtype="<i8").tobytes(),
    }
    assert _peak(lambda: S._ranges(pa.Table.from_pylist([row]))) < 200e6
