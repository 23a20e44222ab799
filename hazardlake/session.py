"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Partitions of rebalanced writes aim at this size: smaller ones are merged, larger ones split.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Window state grows with zones x open windows, so it is kept off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each batch then uploads its changes instead of whole state files.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "hazardlake", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on when the session was built by someone else."""
    for key, value in SETTINGS.items():
        if key == "spark.sql.session.timeZone" or key.startswith("spark.sql.streaming."):
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="hazardlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name under the shared root that no other run uses."""
    return f"{shared_root(spark)}/hazardlake/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.exists(jvm_path)
