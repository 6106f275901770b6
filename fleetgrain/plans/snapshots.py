"""The dated snapshot catalogue and its as-of lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgrain.functions.clock import date_in

# Fixed value: the only names taken as snapshots.
SNAPSHOT_PATTERN = r"^gtfs_(\d{4}-\d{2}-\d{2})(?:T\d{4})?\.zip$"


def catalogue(files: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, snapshot, snap_date, seq, next_snapshot) from file names, in name order.

    One row per archived feed of a network, a few per day at most.
    """
    in_order = Window.partitionBy(*keys).orderBy("name")
    return (
        files.filter(date_in(F.col("name"), SNAPSHOT_PATTERN).isNotNull())
        .select(*keys, "name")
        .distinct()
        .select(
            *keys,
            F.col("name").alias("snapshot"),
            date_in(F.col("name"), SNAPSHOT_PATTERN).alias("snap_date"),
            F.row_number().over(in_order).alias("seq"),
            F.lead("name").over(in_order).alias("next_snapshot"),
        )
    )


def in_range(snapshots: DataFrame, start: str, end: str) -> DataFrame:
    return snapshots.filter(F.col("snap_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def newest(snapshots: DataFrame, keys: list[str]) -> DataFrame:
    return snapshots.groupBy(*keys).agg(F.max("snapshot").alias("snapshot"))


def as_of(days: DataFrame, snapshots: DataFrame, keys: list[str]) -> DataFrame:
    """The feed answering for each day, whether it is a fallback, and its successor.

    A day takes the first capture of its own date, else the last capture of
    the nearest earlier date, else the earliest capture as a fallback. Days
    and snapshot dates merge into one timeline per network, so this is one
    window over dates instead of a range join.
    """
    dated = snapshots.groupBy(*keys, F.col("snap_date").alias("service_date")).agg(
        F.min("snapshot").alias("first_of_date"), F.max("snapshot").alias("last_of_date")
    )
    wanted = days.select(*keys, "service_date").distinct().withColumn("_day", F.lit(True))
    timeline = wanted.join(dated, [*keys, "service_date"], "full_outer")
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("service_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*keys)
    chosen = F.coalesce("first_of_date", F.last("last_of_date", ignorenulls=True).over(earlier))
    placed = (
        timeline.withColumn("_chosen", chosen)
        .withColumn("_earliest", F.min("first_of_date").over(whole))
        .filter("_day")
        .select(
            *keys,
            "service_date",
            F.coalesce("_chosen", "_earliest").alias("snapshot"),
            F.col("_chosen").isNull().alias("is_fallback"),
        )
    )
    successors = snapshots.select(*keys, "snapshot", "next_snapshot")
    return placed.join(successors, [*keys, "snapshot"], "left").select(
        *keys, "service_date", "snapshot", "is_fallback", "next_snapshot"
    )


def unloaded_feeds(recorded: DataFrame, loaded: DataFrame) -> DataFrame:
    """Feeds an upstream run used that this run did not load."""
    return recorded.select("snapshot").distinct().join(loaded, "snapshot", "left_anti")
