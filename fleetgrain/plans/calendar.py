"""Scheduled trips per day and route, and the signature of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.functions.keys import counts_key


def active_services(calendar_dates: DataFrame) -> DataFrame:
    """Distinct (snapshot, service_date, service_id) that run; only additions count."""
    return (
        calendar_dates.filter(F.col("exception_type") == "1")
        .select("snapshot", F.to_date("date", "yyyyMMdd").alias("service_date"), "service_id")
        .distinct()
    )


def scheduled_trips(days: DataFrame, services: DataFrame, trips: DataFrame) -> DataFrame:
    """(keys of days, route_id, trips). Trips are counted per service before the join."""
    per_service = trips.groupBy("snapshot", "service_id", "route_id").agg(
        F.count(F.lit(1)).alias("_trips")
    )
    return (
        days.join(services, ["snapshot", "service_date"])
        .join(per_service, ["snapshot", "service_id"])
        .groupBy(*days.columns, "route_id")
        .agg(F.sum("_trips").alias("trips"))
    )


def signatures(days: DataFrame, scheduled: DataFrame) -> DataFrame:
    """Each day with its counts, trip_count and signature; a day without rows has empty counts."""
    keys = days.columns
    pair = F.struct("route_id", "trips")
    per_day = scheduled.groupBy(*keys).agg(F.sort_array(F.collect_list(pair)).alias("pairs"))
    nothing = F.array().cast("array<struct<route_id:string,trips:bigint>>")
    joined = days.join(per_day, keys, "left").withColumn("pairs", F.coalesce("pairs", nothing))
    return joined.select(
        *keys,
        F.map_from_entries("pairs").alias("counts"),
        F.aggregate("pairs", F.lit(0).cast("bigint"), lambda a, p: a + p["trips"]).alias("trip_count"),
        counts_key(F.col("pairs")).alias("signature_key"),
    )


def churn(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Trips separating two timetables given as (keys, route_id, trips)."""
    both = left.withColumn("signed", F.col("trips")).unionByName(
        right.withColumn("signed", -F.col("trips"))
    )
    return (
        both.groupBy(*keys, "route_id")
        .agg(F.abs(F.sum("signed")).alias("moved"))
        .groupBy(*keys)
        .agg(F.sum("moved").alias("churn"))
    )
