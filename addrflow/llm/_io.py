"""Staged tables and row numbers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrflow.session import drop_staged, ensure_checkpoint_dir

#: The folders that ``stage`` has written and nobody has dropped.
_FOLDERS: list[str] = []
#: Spark's setting to delete a query's shuffle files when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared checkpoint folder and read it back.

    A written table cuts the lineage and survives lost executors. The folder name holds a fresh
    run id, so two runs never overwrite each other. Nothing reads the shuffles behind it again, so
    their files go once it is written, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/addrflow-llm-{uuid.uuid4().hex}"
    path = f"{folder}/{name}"
    _FOLDERS.append(folder)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stages_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete what the operators stage inside the block, at its end (some of it are texts in the clear).

    Frames that an operator returns read staged tables, so they are to be written inside the block.
    """
    before = len(_FOLDERS)
    try:
        yield
    finally:
        for folder in _FOLDERS[before:]:
            drop_staged(spark, folder)
        del _FOLDERS[before:]


def stage_numbered(df: DataFrame, row_col: str, name: str) -> DataFrame:
    """Stage ``df`` with a unique row number; once written, the numbers no longer change."""
    return stage(df.withColumn(row_col, F.monotonically_increasing_id()), name)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
