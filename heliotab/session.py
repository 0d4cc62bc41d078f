"""Session settings and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings that the operators rely on for right results or safe plans.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A commit writes what a batch changed; the whole state is uploaded in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# What one shuffle partition should hold, so that it sorts in executor memory.
PARTITION_BYTES = 128 * 1024 * 1024


def sizing(input_bytes: int) -> dict[str, str]:
    """Settings for a job over ``input_bytes`` of data; adaptive execution merges what is too many."""
    partitions = max(200, input_bytes // PARTITION_BYTES)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(2 * PARTITION_BYTES),
    }


def get_session(app_name: str = "heliotab", master: str | None = None, conf: dict | None = None, input_bytes: int = 0) -> SparkSession:
    """A session with the settings above, sized for ``input_bytes`` when given."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    sized = sizing(input_bytes) if input_bytes else {}
    for key, value in {**RUNTIME_CONF, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="heliotab-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write a small table to the shared folder once and read it back.

    Statistics that several scans join are computed a single time this way, lost executors do not
    bring them back to life from the raw data, and Spark knows the size of the file: it broadcasts
    the table while it is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_stats(df: DataFrame, stats: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join statistics of one row per key; without keys that one row becomes constants."""
    if keys:
        return df.join(stats, list(keys), how)
    row = stats.first()
    return df.withColumns(
        {f.name: F.lit(row[f.name] if row else None).cast(f.dataType) for f in stats.schema}
    )
