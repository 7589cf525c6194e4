"""Structured Streaming runner: raw shipment files in, contact rows to a sink, at least once.

``foreachBatch`` replays a failed batch as a whole, so a sink that appends must use the batch id to
skip a batch it has already written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from addrflow.config import JobConfig
from addrflow.operators.contacts import contact_rows
from addrflow.operators.filters import canonical_rows
from addrflow.schema import SHIPMENT_SCHEMA
from addrflow.session import ensure_checkpoint_dir


def contacts_stream(rows: DataFrame, key_export: DataFrame, pincodes: DataFrame, cfg: JobConfig) -> DataFrame:
    """Streaming (or batch) raw shipment rows -> contact rows; the lookups are static DataFrames."""
    canonical = canonical_rows(rows, cfg.timestamp_format)
    return contact_rows(canonical, pincodes, cfg, key_export=key_export)


def run_incremental(
    spark: SparkSession,
    source_dir: str,
    key_export: DataFrame,
    pincodes: DataFrame,
    cfg: JobConfig,
    sink: Callable[[DataFrame, int], None],
    name: str = "contacts",
    source_format: str = "parquet",
) -> StreamingQuery:
    """Process every raw file not yet seen under ``source_dir`` and stop (``availableNow``).

    Progress is kept under the session's checkpoint folder, by ``name`` and source folder, so a
    re-run skips files already written; a failed batch is replayed as a whole.
    """
    rows = spark.readStream.format(source_format).schema(SHIPMENT_SCHEMA).load(source_dir)
    out = contacts_stream(rows, key_export, pincodes, cfg)
    folder = hashlib.sha256(source_dir.encode()).hexdigest()[:16]
    checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}-{folder}"
    return (
        out.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName(name)
        .start()
    )
