"""Small state tables kept per micro-batch.

Batch N reads the newest state before N and writes state N. A repeated batch
reads the same state and replaces its own output, so results are exactly once
after any failure. A state that no repeat can ask for any more is deleted, so
at most two batches of it are kept. The folder must be one every executor sees.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrain.sinks import overwrite_partitions


class BatchState:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, batch BIGINT").parquet(self.path)

    def before(self, batch_id: int) -> DataFrame:
        """State left by the batch before; empty at the start."""
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        return self._stored().filter(F.col("batch") == batch_id - 1).drop("batch")

    def save(self, state: DataFrame, batch_id: int) -> None:
        """One file set per batch, also when the state is empty."""
        out = state.withColumn("batch", F.lit(batch_id).cast("bigint"))
        overwrite_partitions(out, self.path, ["batch"])
        drop_older(self.spark, self.path, batch_id)


class DayState(BatchState):
    """State by service day: a batch reads and rewrites its own days only, and no day is ever given up."""

    def before_days(self, batch_id: int, days: DataFrame) -> DataFrame:
        """The newest state before this batch of each of `days` (service_date)."""
        if not _exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        older = self._stored().filter(F.col("batch") < batch_id).join(F.broadcast(days), "service_date", "left_semi")
        newest = older.groupBy("service_date").agg(F.max("batch").alias("batch"))
        return older.join(F.broadcast(newest), ["service_date", "batch"]).select(*[c.split()[0] for c in self.schema.split(", ")])

    def save(self, state: DataFrame, batch_id: int) -> None:
        out = state.withColumn("batch", F.lit(batch_id).cast("bigint"))
        overwrite_partitions(out, self.path, ["service_date", "batch"])
        for day in _children(self.spark, self.path, "service_date"):  # one folder per day
            drop_older(self.spark, f"{self.path}/{day}", batch_id)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _exists(spark: SparkSession, path: str) -> bool:
    system, hadoop = _file_system(spark, path)
    return system.exists(hadoop)


def _children(spark: SparkSession, path: str, column: str) -> list[str]:
    system, hadoop = _file_system(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(hadoop)] if system.exists(hadoop) else []
    return [n for n in names if n.startswith(f"{column}=")]


def drop_older(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete all states below `path` but that of the batch and the newest before it."""
    kept = {int(re.sub("batch=", "", name)): name for name in _children(spark, path, "batch")}
    older = sorted(n for n in kept if n < batch_id)
    system, _ = _file_system(spark, path)
    for n in older[:-1]:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kept[n]}"), True)
