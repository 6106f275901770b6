"""Writers. A day, period or slot is rewritten whole, so reruns replace and never add."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace exactly the partitions present in `df`.

    Rebalancing gives each partition few files and still splits a hot one.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def stored(spark, path: str, schema) -> DataFrame:
    """A stage read back by its known schema, so one without rows is an empty table and no error."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def replace_tree(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Replace everything under `path`, so stale members vanish."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_samples(samples: DataFrame, path: str) -> None:
    overwrite_partitions(samples, path, ["service_date"])


def write_bins(bins: DataFrame, path: str) -> None:
    overwrite_partitions(bins, path, ["period_key"])


def write_slots(documents: DataFrame, path: str) -> None:
    """One JSON document per slot and bundle, under the slot's folder."""
    name = F.regexp_replace("timeslot", ":", "")
    (
        documents.withColumn("slot", name)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("bundle", "slot")
        .json(path)
    )


def write_geometry(documents: DataFrame, path: str) -> None:
    (
        documents.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("bundle")
        .json(path)
    )


def write_manifests(manifests: DataFrame, path: str) -> None:
    overwrite_partitions(manifests, path, ["service_date"])


def append_runs(runs: DataFrame, path: str, batch_id: int) -> None:
    """Run log; one partition per micro-batch makes a repeated batch replace itself."""
    overwrite_partitions(runs.withColumn("batch", F.lit(batch_id)), path, ["batch"])
