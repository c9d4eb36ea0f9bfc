"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job here relies on.  Shuffle sizing is left to adaptive
# execution: the partition count of the session is only the starting point.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a skewed join partition even if that costs another exchange later on
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # inputs that are hash-partitioned on the hand may be joined on hand + seat as they are
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # rows of some hundred columns between windows still run as generated code
    "spark.sql.codegen.maxFields": "300",
    # dt=2024-01-30 in a path stays text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # remembered event ids lie on disk, not in an executor's heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# The table jobs: exchanged rows are narrow and packed, and a task sorts them several times after they
# have been joined and spread, so its share of an exchange is small and their number follows the input.
TABLE_SIZES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
}


def tune(spark: SparkSession, tables: bool = False) -> SparkSession:
    """Apply the settings above to a running session (ANSI mode is left as it is: on).

    tables: with the sizes of the table jobs; without, those an earlier call has set go.
    """
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    for key, value in TABLE_SIZES.items():
        if tables:
            spark.conf.set(key, value)
        elif spark.conf.get(key, None) == value:
            spark.conf.unset(key)
    return spark


def local_session(cores: str = "*", name: str = "tablehouse", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster job brings its own and calls `tune`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder path for intermediate tables that every executor can reach.

    The parent is what the cluster names in ``spark.checkpoint.dir``.  Only a local
    master may fall back to the machine's own temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tablehouse-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
