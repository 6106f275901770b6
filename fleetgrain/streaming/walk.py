"""The walk over a stream of positions, and typical bins kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgrain.operators import bins, walk
from fleetgrain.params import WalkParams
from fleetgrain import sinks
from fleetgrain.session import cut_lineage
from fleetgrain.sinks import overwrite_partitions
from fleetgrain.streaming.state import DayState

_ANCHORS = "service_date DATE, vehicle_id STRING, trip_id STRING, anchor_ts BIGINT, anchor_m DOUBLE"


def start_walk(
    positions: DataFrame,
    day_plan: DataFrame,
    trips: DataFrame,
    shapes: DataFrame,
    params: WalkParams,
    order: list[str],
    out: str,
    checkpoint: str,
    trigger: dict,
) -> StreamingQuery:
    """Steps per micro-batch; open walks go on from their anchor of the batch before.

    Equal to the batch walk when each vehicle's fixes arrive in time order,
    however late a day's fixes come: anchors are kept by service day, and a
    batch reads and writes those of its own days.
    """
    state = DayState(positions.sparkSession, f"{out}/anchors", _ANCHORS)

    def judge(batch: DataFrame, batch_id: int) -> None:
        before = state.before_days(batch_id, batch.select("service_date").distinct())
        steps = walk.walk(batch, day_plan, trips, shapes, params, order, anchors=before)
        overwrite_partitions(
            steps.withColumn("batch", F.lit(batch_id)), f"{out}/steps", ["batch", "service_date"]
        )
        done = batch.sparkSession.read.parquet(f"{out}/steps").filter(F.col("batch") == batch_id)
        state.save(_next_anchors(done, before), batch_id)

    return (
        positions.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _next_anchors(done: DataFrame, before: DataFrame) -> DataFrame:
    fresh = done.filter("anchor_ts IS NOT NULL").groupBy(*walk.WALK_KEYS).agg(
        F.max_by(F.struct("anchor_ts", "anchor_m"), "snapshot_ts").alias("a")
    )
    fresh = fresh.select(*walk.WALK_KEYS, "a.anchor_ts", "a.anchor_m")
    old = before.join(fresh.select(*walk.WALK_KEYS), walk.WALK_KEYS, "left_anti")
    return cut_lineage(old.unionByName(fresh))  # the states it is made from may be deleted


def start_typical(
    samples: DataFrame, day_plan: DataFrame, out: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Keep `out`/bins current: a batch stores its samples, then redoes the bins they touch.

    A median needs all its values, so touched bins are computed again from the
    stored samples; the other bins of their periods are taken over.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = f"{out}/samples"
        overwrite_partitions(batch.withColumn("batch", F.lit(batch_id)), stored, ["service_date", "batch"])
        fresh = spark.read.parquet(stored).filter(F.col("batch") == batch_id)
        days = day_plan.filter("period_key IS NOT NULL").select("service_date", "period_key")
        touched = cut_lineage(fresh.join(days, "service_date").select("period_key", *bins.BIN_KEYS).distinct())
        periods = F.broadcast(touched.select("period_key").distinct())  # a few per year
        plan = days.join(periods, "period_key", "left_semi")
        behind = spark.read.parquet(stored).join(plan, "service_date").join(touched, ["period_key", *bins.BIN_KEYS], "left_semi")
        made = bins.typical_bins(behind.drop("period_key"), plan)
        held = sinks.stored(spark, f"{out}/bins", made.schema).join(periods, "period_key", "left_semi")
        rest = held.join(touched, ["period_key", *bins.BIN_KEYS], "left_anti")
        sinks.write_bins(cut_lineage(made.unionByName(rest)), f"{out}/bins")

    return (
        samples.writeStream.foreachBatch(update)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
