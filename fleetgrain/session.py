"""Session settings the results depend on, and the checkpoint folder."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the walk is busy with few bytes, so partitions may shrink before cores idle
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows with a line's vectors are long, and a worker holds a batch several times
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def ship_kernels() -> None:
    """Send the package's functions with each task, so executors need no install."""
    cloudpickle.register_pickle_by_value(sys.modules["fleetgrain"])


def build_session(master: str | None = None, app: str = "fleetgrain", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    ship_kernels()
    return builder.getOrCreate()


def apply_conf(spark: SparkSession) -> SparkSession:
    """Set the settings results depend on in a session built elsewhere."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    ship_kernels()
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session falls back to its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor sees")
    made = tempfile.mkdtemp(prefix="fleetgrain-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back, so several consumers share one computation.

    A Parquet table outlives executors, and readers prune its columns and see
    its size, which a checkpoint would hide.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
