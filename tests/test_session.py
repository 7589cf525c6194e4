"""Session helpers: checkpoint folder from the session, staged tables, sizing."""

import uuid

from addrflow.session import ensure_checkpoint_dir, stage_table, suggested_conf


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    assert got and (configured is None or got == configured)


def test_stage_table_round_trip(spark):
    df = spark.range(100).selectExpr("id", "cast(id * 2 as string) AS v")
    staged = stage_table(df, f"test-{uuid.uuid4().hex}")
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, df.collect()))
    assert ensure_checkpoint_dir(spark).rstrip("/") in staged.inputFiles()[0]


def test_suggested_conf_scales_with_input():
    small, big = suggested_conf(1 << 30), suggested_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_cluster_session_needs_a_shared_checkpoint_dir():
    """Only local mode may fall back to a scratch folder of the machine."""
    import pytest

    class _Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Session:
        conf = _Conf()
        sparkContext = _Ctx()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session())


def test_runs_never_share_a_staged_folder(spark):
    from addrflow.session import drop_staged, staging_path

    assert staging_path(spark, "x") != staging_path(spark, "x")
    path = staging_path(spark, "gone")
    staged = stage_table(spark.range(3), "gone", spark, path)
    assert staged.count() == 3
    drop_staged(spark, path)
    try:
        left = spark.read.parquet(path).count()
    except Exception:
        left = 0
    assert left == 0
