"""From an archive folder to samples, bins and the run's record, stage by stage.

Every stage writes a table and the next one reads it, so nothing is computed
twice and a lost job starts again from its last finished stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrain.operators import bins, reconcile, shapes, walk
from fleetgrain.params import WalkParams
from fleetgrain.plans import calendar, periods, snapshots
from fleetgrain.sinks import overwrite_partitions, replace_tree, stored, write_samples
from fleetgrain.sources import gtfs, jsonl, listings

NETWORK = ["city"]
_DAY_GLOB = "????-??-??.jsonl*"


@dataclass(frozen=True)
class Static:
    """Typed feed tables of every snapshot, plus the catalogue."""

    catalogue: DataFrame
    trips: DataFrame
    shapes: DataFrame
    bridge: DataFrame
    routes: DataFrame
    calendar_dates: DataFrame
    feed_info: DataFrame
    unusable: DataFrame


def load_static(spark: SparkSession, folder: str, out: str, city: str) -> Static:
    """Unzip each member once into a table under `out`, then work from those.

    An archive that can't be opened or lacks a required member enters neither
    the catalogue nor any table; `out`/unusable names it with what it lacks.
    """
    found = gtfs.read_archives(spark, folder)
    lacking = gtfs.usability(found, gtfs.member_names(found)).filter(F.size("missing") > 0)
    replace_tree(lacking, f"{out}/unusable")
    unusable = stored(spark, f"{out}/unusable", lacking.schema)
    # one row per archived feed
    archives = found.join(F.broadcast(unusable.select("snapshot")), "snapshot", "left_anti")
    names = archives.select("snapshot")  # contents are pruned from this scan
    tables = {"routes": gtfs.routes, "calendar_dates": gtfs.calendar_dates, "feed_info": gtfs.feed_info}
    for name, read in tables.items():
        replace_tree(read(archives), f"{out}/{name}")
    keyed = shapes.keyed_points(gtfs.shape_points(archives), ["snapshot", "shape_id"])
    replace_tree(keyed, f"{out}/lines")
    keyed = spark.read.parquet(f"{out}/lines")
    replace_tree(shapes.build_shapes(keyed), f"{out}/shapes")
    known = keyed.select("snapshot", "shape_id", "shape_key")
    # a shape id without points still gets a key, of an empty geometry, and no shape
    trips = gtfs.trips(archives).join(known, ["snapshot", "shape_id"], "left")
    replace_tree(trips.withColumn("shape_key", F.coalesce("shape_key", F.lit(EMPTY_KEY))), f"{out}/trips")
    files = names.select(F.lit(city).alias("city"), F.col("snapshot").alias("name"))
    return Static(
        catalogue=snapshots.catalogue(files, NETWORK),
        trips=spark.read.parquet(f"{out}/trips"),
        shapes=spark.read.parquet(f"{out}/shapes"),
        bridge=shapes.shape_bridge(keyed),
        routes=spark.read.parquet(f"{out}/routes"),
        calendar_dates=spark.read.parquet(f"{out}/calendar_dates"),
        feed_info=spark.read.parquet(f"{out}/feed_info"),
        unusable=unusable,
    )


# Fixed value: the key of a geometry without points.
EMPTY_KEY = "e3b0c44298fc1c14"


def plan_days(days: DataFrame, static: Static) -> DataFrame:
    """Feed, signature and period of every planned day; `days` has (city, service_date, processed)."""
    placed = snapshots.as_of(days, static.catalogue, NETWORK)
    keys = days.join(placed, [*NETWORK, "service_date"])
    wanted = keys.select(*NETWORK, "service_date", "snapshot")
    sched = calendar.scheduled_trips(
        wanted, calendar.active_services(static.calendar_dates), static.trips
    )
    signed = calendar.signatures(wanted, sched).drop("snapshot")
    return periods.assign_periods(keys.join(signed, [*NETWORK, "service_date"]), NETWORK)


@dataclass(frozen=True)
class SpeedsRun:
    day_plan: DataFrame
    samples: DataFrame
    bins: DataFrame
    days: DataFrame
    summary: DataFrame
    unusable: DataFrame


# what the walk and its counters read of a position record
POSITION_COLUMNS = ["service_date", "snapshot_ts", "vehicle_id", "trip_id", "lat", "lon", "speed_ms", *jsonl.FILE_ORDER]


def run_speeds(
    spark: SparkSession,
    data_dir: str,
    static_dir: str,
    out: str,
    city: str,
    params: WalkParams,
    today: Column | None = None,
    dates: Sequence[str] = (),
) -> SpeedsRun:
    """Read day files, walk every trip, and write samples, bins and records under `out`.

    The plan covers the whole archive, so period keys do not depend on `dates`.
    Records of this run count the days it processed, whatever `out` held before.
    """
    static = load_static(spark, static_dir, f"{out}/static", city)
    today = F.to_date(F.from_utc_timestamp(F.current_timestamp(), params.timezone)) if today is None else today
    files = reconcile.choose_day_files(listings.list_files(spark, data_dir, _DAY_GLOB))
    chosen = reconcile.selected_days(files, today, list(dates) or None)
    days = reconcile.planning_days(files, today, chosen).withColumn("city", F.lit(city))
    replace_tree(plan_days(days, static), f"{out}/day_plan")
    plan = spark.read.parquet(f"{out}/day_plan")
    # one path per requested day file: the list is as long as the calendar
    paths = [f"{data_dir}/{r['name']}" for r in chosen.select("name").collect()]
    if not paths:
        raise ValueError(f"no day files found in {data_dir}")
    # day files are parsed once; all counts start from the table
    parsed = jsonl.read_positions(spark, paths).select(*POSITION_COLUMNS)
    replace_tree(parsed, f"{out}/positions", ["service_date"])
    positions = stored(spark, f"{out}/positions", parsed.schema)
    processed = plan.filter("processed").select("service_date")
    walked = walk.walk(positions, plan, static.trips, static.shapes, params, jsonl.FILE_ORDER)
    overwrite_partitions(walked, f"{out}/steps", ["service_date"])
    steps = stored(spark, f"{out}/steps", walked.schema).join(processed, "service_date", "left_semi")
    sampled = walk.samples(steps, params)
    write_samples(sampled, f"{out}/samples")
    samples = stored(spark, f"{out}/samples", sampled.schema).join(processed, "service_date", "left_semi")
    typical = bins.typical_bins(samples, plan)
    replace_tree(typical, f"{out}/bins", ["period_key"])
    made = stored(spark, f"{out}/bins", typical.schema)
    counters = bins.day_counters(
        walk.outcomes(steps).unionByName(walk.keyless_records(positions)).unionByName(walk.unusable_fixes(positions))
    )
    from_next = walk.next_feed_counts(positions, plan, static.trips)
    replace_tree(_day_records(plan, counters, from_next), f"{out}/days")
    replace_tree(_summary(samples, made, static.bridge), f"{out}/summary")
    replace_tree(
        periods.period_summary(plan.filter("processed"), bins.bins_per_period(made), NETWORK).orderBy(*NETWORK, "first_date"),
        f"{out}/periods",
    )
    days, summary = (spark.read.parquet(f"{out}/{name}") for name in ("days", "summary"))
    return SpeedsRun(plan, samples, made, days, summary, static.unusable)


def _day_records(plan: DataFrame, counters: DataFrame, next_feed: DataFrame) -> DataFrame:
    """Per processed day: feed, timetable and counters; the total row has a null date."""
    facts = plan.filter("processed").select(
        "service_date",
        "snapshot",
        "is_fallback",
        "next_snapshot",
        "signature_key",
        "period_key",
        "excluded_from_median",
        "trip_count",
    )
    joined = counters.join(facts, "service_date", "left").join(next_feed, "service_date", "left")
    whole = joined.fillna(0, ["records_from_next_feed", "trips_from_next_feed"])
    return whole.orderBy(F.col("service_date").asc_nulls_last())


def _summary(samples: DataFrame, stored: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row: validation against the feed's speed, bin totals, identity conflicts."""
    parts = [
        bins.feed_speed_validation(samples),
        bins.bin_totals(stored),
        shapes.identity_conflicts(bridge),
    ]
    out = parts[1]
    for part in (parts[0], parts[2]):  # each is a single row; validation may have none
        out = out.withColumn("_one", F.lit(1)).join(part.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
    return out
