import os
from urllib.parse import urlparse

from llm_util import odd_docs

from addrflow.llm import exact_dedup
from addrflow.llm._io import _FOLDERS, stage, stages_dropped


def test_staged_tables_go_at_the_end_of_the_block(spark, tmp_path):
    rows, docs = odd_docs(spark)
    kept = stage(docs, "kept")
    before = list(_FOLDERS)
    with stages_dropped(spark):
        exact_dedup.deduplicate(kept).write.parquet(f"{tmp_path}/out")
        made = _FOLDERS[len(before):]
        assert made and all(os.path.isdir(urlparse(f).path) for f in made)
    assert not any(os.path.exists(urlparse(f).path) for f in made)
    assert _FOLDERS == before and kept.count() == len(rows)
    assert spark.read.parquet(f"{tmp_path}/out").count() > 0
