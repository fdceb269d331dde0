"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings a change-capture job wants on any cluster. Sizes (shuffle
# partitions, memory) are left to the cluster; AQE settles them per stage.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method beyond this size. Tables with many columns
    # exceed it in one fused stage; below the limit Spark splits the code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A bucket of a lake table is one sorted file: merges read it without sorting.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # Partitioned lake tables are bucketed by the key, and merged by key and partition.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB with incremental checkpoints; stateful
    operators with their own state need it. Set before a query starts."""
    for name, value in JOB_SETTINGS.items():
        if "stateStore" in name:
            spark.conf.set(name, value)


def local_session(cpus: str = "*", app: str = "tidewell", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        # Plans show filters whole; a session that has run long has long column numbers.
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidewell-wh-"))
    )
    for name, value in JOB_SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one process.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tidewell-")
    context.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name under the shared root."""
    return f"{shared_root(spark)}/tidewell/{label}-{uuid.uuid4().hex}"
