"""The transform on a stream: files processed once, same rows as the batch path."""

import tempfile
import uuid

from addrflow.plans.queries import CFG, assembled
from addrflow.sources import driver_tables as D
from addrflow.streaming.incremental import contacts_stream, run_incremental
from tests.conftest import SF_SMALL


def test_incremental_run_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="addrflow-stream-src-")
    rows = assembled(spark, SF_SMALL, CFG, encrypted=True)
    rows.write.mode("overwrite").parquet(src + "/batch1")
    keys, pins = D.key_export(spark, SF_SMALL), D.pincode_lookup(spark, SF_SMALL)
    got = []

    def sink(df, epoch):
        got.extend(tuple(r) for r in df.collect())

    name = f"test-{uuid.uuid4().hex}"  # the checkpoint folder is shared and persists across runs
    q = run_incremental(spark, src + "/batch1", keys, pins, CFG, sink, name=name)
    q.awaitTermination(120)
    want = [tuple(r) for r in contacts_stream(rows, keys, pins, CFG).collect()]
    assert sorted(got) == sorted(want) and len(got) > 0
    # a second run sees no new files and writes nothing
    before = len(got)
    q2 = run_incremental(spark, src + "/batch1", keys, pins, CFG, sink, name=name)
    q2.awaitTermination(120)
    assert len(got) == before
