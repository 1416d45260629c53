"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "maintspark",
                  extra: dict | None = None) -> SparkSession:
    """A local[N] session with the settings the operators assume (UTC, AQE on, UI off)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The cluster names it; only when it is unset (local tests) a fresh scratch
    folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
    folder = tempfile.mkdtemp(prefix="maintspark-ckpt-", dir=os.environ.get("MAINTSPARK_SCRATCH", "/tmp"))
    sc.setCheckpointDir(folder)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location of a named stream inside the shared checkpoint folder, so a
    restarted query (or one whose executors were lost) resumes its state and offsets."""
    # the configured folder itself: Spark's checkpoint folder is a new subfolder for each application
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/streams/{name}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{stream_checkpoint(spark, name)}-{uuid.uuid4().hex}"


def rocksdb_state(spark: SparkSession) -> None:
    """Keep the state of streaming queries in RocksDB (changed keys only are written)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def cluster_conf(input_bytes: int, executors: int = 1000, cores_per_executor: int = 4) -> dict[str, str]:
    """Settings for a large cluster run, sized from the bytes the job reads.

    Shuffle partitions start at ~64 MB of input each (at least two waves of tasks) and
    AQE coalesces them toward 128 MB after each stage and splits skewed join partitions;
    scans split files at 256 MB; only tables under 64 MB are broadcast automatically
    (explicit broadcasts in the operators are row-bounded separately)."""
    slots = executors * cores_per_executor
    partitions = max(2 * slots, input_bytes // (64 << 20))
    return {
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
