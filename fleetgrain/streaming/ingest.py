"""Landed poll responses to positions and heartbeats by local date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgrain.functions.clock import local_date
from fleetgrain.sinks import overwrite_partitions
from fleetgrain.sources.jsonl import ENTITY_SCHEMA, poll_audit, records_inside, vehicle_records


def poll_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(ENTITY_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )


def start_ingest(
    polls: DataFrame, out: str, checkpoint: str, tz, box: Column, trigger: dict
) -> StreamingQuery:
    """Positions first, then the heartbeat that vouches for them.

    Each micro-batch owns a `batch` partition below its dates, so a repeated
    batch replaces what its first attempt wrote.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        def dated(df: DataFrame) -> DataFrame:
            return df.withColumn("service_date", local_date(F.col("snapshot_ts"), tz)).withColumn(
                "batch", F.lit(batch_id)
            )

        by = ["service_date", "batch"]
        overwrite_partitions(dated(records_inside(vehicle_records(batch), box)), f"{out}/positions", by)
        overwrite_partitions(dated(poll_audit(batch, box)), f"{out}/polls", by)

    return (
        polls.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
