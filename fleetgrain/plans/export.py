"""Bins to serving tables: all bundles of a run in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.operators import bins as bin_ops
from fleetgrain.operators import reconcile, serve
from fleetgrain.params import (
    BACKWARD_TOLERANCE_M,
    BASELINE_MIN_SLOTS,
    COORD_DECIMALS,
    MAX_SPEED_KMH,
    MAX_TIME_GAP_SEC,
    MIN_GAP_CADENCE_FRACTION,
    MIN_SAMPLES,
    SEARCH_MARGIN_M,
    SEGMENT_LENGTH_M,
    SIMPLIFY_TOLERANCE_M,
    SLOWDOWN_ABS_MIN_KMH,
    SLOWDOWN_RATIO_MAX,
    TIMESLOT_MINUTES,
)
from fleetgrain.plans import periods
from fleetgrain.plans.pipeline import NETWORK, Static
from fleetgrain.sinks import replace_tree, write_geometry, write_slots

# The parameters a bundle states about itself.
STATED = {
    "segment_length_m": SEGMENT_LENGTH_M,
    "timeslot_minutes": TIMESLOT_MINUTES,
    "max_time_gap_sec": MAX_TIME_GAP_SEC,
    "min_time_gap_cadence_fraction": MIN_GAP_CADENCE_FRACTION,
    "max_speed_kmh": MAX_SPEED_KMH,
    "backward_tolerance_m": BACKWARD_TOLERANCE_M,
    "search_margin_m": SEARCH_MARGIN_M,
    "simplify_tolerance_m": SIMPLIFY_TOLERANCE_M,
    "coordinate_decimal_places": COORD_DECIMALS,
    "slowdown_ratio_max": SLOWDOWN_RATIO_MAX,
    "slowdown_absolute_min_kmh": SLOWDOWN_ABS_MIN_KMH,
    "baseline_min_slots": BASELINE_MIN_SLOTS,
}


# The two kinds of bundle and the version of their layout.
TYPICAL, SINGLE_DAY = "typical_weekday", "day"
FORMAT_VERSION = 2

PERIOD_TYPE = (
    "struct<period_key: string, reference_date: date, first_date: date, last_date: date, route_count: int, trip_count: bigint>"
)


def period_bundles(bins: DataFrame) -> DataFrame:
    return bins.withColumnRenamed("period_key", "bundle")


def day_bundles(samples: DataFrame) -> DataFrame:
    """One bundle per day, weekends included, from the day's own samples."""
    days = bin_ops.day_bins(samples)
    return days.select(
        F.date_format("service_date", "yyyy-MM-dd").alias("bundle"), *bin_ops.BIN_KEYS, "median_speed_ms", "n_samples"
    )


def export_bundles(
    bundles: DataFrame,
    days: DataFrame,
    static: Static,
    manifests: DataFrame | None,
    out: str,
    min_samples: int = MIN_SAMPLES,
    mode: str = TYPICAL,
    about: DataFrame | None = None,
    attribution: str | None = None,
    source: str | None = None,
) -> DataFrame:
    """Write slots, segments and the bundle records under `out`; returns the records.

    `days` has (bundle, service_date), the days behind each bundle; `about` describes
    schedule periods by period_key. Only bundles of a typical weekday have a baseline.
    """
    spark = bundles.sparkSession
    kept = serve.retained_bins(bundles, min_samples)
    indexed = serve.index_segments(serve.retained_segments(kept, static.shapes))
    replace_tree(indexed, f"{out}/index")
    indexed = spark.read.parquet(f"{out}/index")
    slots = serve.slot_bins(kept, indexed)
    replace_tree(slots, f"{out}/slots", ["bundle"])
    slots = spark.read.parquet(f"{out}/slots").withColumn("bundle", F.col("bundle").cast("string"))
    routes = serve.shape_routes(static.bridge, static.trips, static.routes, static.catalogue)
    paths = indexed.join(serve.draw_paths(indexed, static.shapes), serve.PAIR)
    placed = serve.point_offsets(paths).join(routes, "shape_key", "left")
    baseline = serve.segment_baseline(slots) if mode == TYPICAL else None
    if baseline is not None:
        placed = placed.join(
            baseline.select("bundle", "segment_idx", "typical_kmh"), ["bundle", "segment_idx"], "left"
        )
    replace_tree(placed, f"{out}/segments", ["bundle"])
    placed = spark.read.parquet(f"{out}/segments").withColumn("bundle", F.col("bundle").cast("string"))
    reconcile.require_empty(serve.undrawable(slots, placed), "a slot names a segment without a path")
    write_slots(serve.slot_documents(slots), f"{out}/slot_documents")
    table = serve.shape_table(indexed, routes)
    write_geometry(serve.geometry_document(placed.drop("typical_kmh"), table, baseline), f"{out}/geometry")
    records = bundle_records(bundles, days, static.shapes, slots, table, manifests, min_samples, mode, about)
    stated = records.withColumns(
        {
            "attribution": F.lit(attribution).cast("string"),
            "source": F.lit(source).cast("string"),
            "generated_at": F.current_timestamp(),
        }
    )
    replace_tree(stated, f"{out}/bundles")
    return spark.read.parquet(f"{out}/bundles")


def bundle_records(
    bundles: DataFrame,
    days: DataFrame,
    shapes: DataFrame,
    slots: DataFrame,
    table: DataFrame,
    manifests: DataFrame | None = None,
    min_samples: int = MIN_SAMPLES,
    mode: str = TYPICAL,
    about: DataFrame | None = None,
) -> DataFrame:
    """What each bundle states about itself: mode, period, days, counts and the parameters behind it.

    `table` is the bundles' `shape_table`. schedule_period is null for single days and where `about` has no row.
    """
    counts = serve.bundle_counts(bundles, shapes, min_samples)
    listed = days.groupBy("bundle").agg(F.sort_array(F.collect_list("service_date")).alias("days_in_median"))
    labels = slots.groupBy("bundle").agg(F.sort_array(F.collect_set("timeslot")).alias("timeslots"))
    several = table.filter(F.size("route_ids") > 1).groupBy("bundle").agg(
        F.count(F.lit(1)).alias("multi_route_shapes")
    )
    out = counts
    for part in (listed, labels, several):
        out = out.join(part, "bundle", "left")
    if manifests is not None:
        notes = serve.incomplete_days(days, manifests).groupBy("bundle").agg(
            F.map_from_entries(F.collect_list(F.struct(F.col("service_date").cast("string"), "note"))).alias(
                "incomplete_days"
            )
        )
        out = out.join(notes, "bundle", "left")
    period = F.struct("period_key", "reference_date", "first_date", "last_date", "route_count", "trip_count")
    if mode == TYPICAL and about is not None:
        described = about.select(F.col("period_key").alias("bundle"), period.alias("schedule_period"))
        out = out.join(described, "bundle", "left")
    else:
        out = out.withColumn("schedule_period", F.lit(None).cast(PERIOD_TYPE))
    none = F.array().cast(out.schema["timeslots"].dataType)
    stated = [F.lit(value).alias(name) for name, value in STATED.items()]
    return (
        out.fillna(0, ["multi_route_shapes"])
        .withColumn("timeslots", F.coalesce("timeslots", none))
        .select(
            "*",
            F.size("timeslots").alias("timeslot_count"),
            (F.col("bins_before") - F.col("bins_after")).alias("bins_dropped"),
            F.lit(FORMAT_VERSION).alias("format_version"),
            F.lit(mode).alias("mode"),
            F.lit(min_samples).alias("min_samples"),
            *stated,
        )
    )


def bundle_index(records: DataFrame, summary: DataFrame) -> DataFrame:
    """Index of the period bundles that exist, the current one marked."""
    current = periods.current_period(
        summary.join(records.select(F.col("bundle").alias("period_key")), "period_key", "left_semi"), NETWORK
    )
    described = records.drop("schedule_period").join(
        summary.select(F.col("period_key").alias("bundle"), "first_date", "last_date", "route_count", "trip_count"),
        "bundle",
        "left",
    )
    return reconcile.period_index(described, current)


def root_index(day_records: DataFrame, period_index_rows: DataFrame) -> DataFrame:
    """What is published: every day bundle that exists, and each period with the current one marked."""
    days = day_records.select(F.lit(SINGLE_DAY).alias("kind"), "bundle", F.lit(False).alias("is_current"))
    typical = period_index_rows.select(F.lit(TYPICAL).alias("kind"), "bundle", "is_current")
    return days.unionByName(typical)
