"""Session helpers: recommended settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the job relies on; applied only by ``local_session`` (tests, bench). On a cluster the
# caller's session is used as given.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizeNullAwareAntiJoin": "true",
}


def suggested_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a run reading ``input_bytes`` (e.g. 100 TB -> ~400k partitions).

    The shuffle partition count is an upper bound sized for ~256 MB partitions; AQE coalesces
    small ones and splits skewed ones at run time.
    """
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "addrflow") -> SparkSession:
    """A local session for tests and benchmarks (UI off, session time zone UTC)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Only a local-mode session without one gets a scratch folder; a cluster session must name a
    shared folder, so staged tables and stream checkpoints survive the loss of any one machine.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        # Executors on other machines could neither see nor survive a folder of this one.
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)")
    # Nothing configured in local mode (tests, bench): a scratch folder of this machine.
    path = tempfile.mkdtemp(prefix="addrflow-ckpt-")
    sc.setCheckpointDir(path)
    return path


def staging_path(spark: SparkSession, name: str) -> str:
    """A folder under the session's checkpoint folder that no other run uses."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"


def stage_table(df, name: str, spark: SparkSession | None = None, path: str | None = None):
    """Write ``df`` as parquet under the session's checkpoint folder and read it back.

    Cuts the lineage at a shared, durable copy: later stages (and retries after an executor loss)
    read the staged files instead of recomputing from the sources. Every call has a folder of its
    own; ``drop_staged`` removes it (staged rows may hold personal data in the clear).
    """
    spark = spark or df.sparkSession
    path = path or staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``stage_table`` (through Hadoop's file systems)."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
