"""Session helpers: a local session for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ticklab") -> SparkSession:
    """Local session used by tests and the bench. Cluster jobs get their session from the launcher."""
    builder = SparkSession.builder.master(f"local[{cores}]")
    if not SparkSession.getActiveSession():
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ticklab-ckpt-"))
    spark = (
        builder
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config(STATE_STORE, ROCKSDB)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster has to name it; only a local session (tests) gets a scratch folder when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        # local mode only: driver and executors are one process there
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ticklab-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def stream_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` with the same settings, but RocksDB as the streams' state store, which operators on
    ``transformWithState`` need and Spark's default is not. The caller's session stays as it is.

    A micro-batch opens and commits a state store a shuffle partition, whatever its size, so there are at most two
    partitions a core."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set(STATE_STORE, ROCKSDB)
    partitions = "spark.sql.shuffle.partitions"
    other.conf.set(partitions, str(min(int(spark.conf.get(partitions)), 2 * spark.sparkContext.defaultParallelism)))
    return other


def materialize(df, tag: str = "table"):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but in one job (an eager RDD checkpoint computes its
    input twice), stores columnar and compressed, and the read-back gets column pruning and
    filter pushdown. Survives executor loss: the files live in the shared folder."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
