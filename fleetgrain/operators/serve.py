"""Serving tables: thresholded bins, segment geometry, slots, baseline, flags."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrain.functions.geo import plane_lat, plane_lon
from fleetgrain.functions.keys import UNKNOWN_ROUTE_TYPE, route_type_label
from fleetgrain.operators.sequences import running_sum_in_buckets
from fleetgrain.params import (
    BASELINE_MIN_SLOTS,
    INCOMPLETE_COVERAGE_PCT,
    KMH_PER_MS,
    MIN_SAMPLES,
    SEGMENT_LENGTH_M,
    SIMPLIFY_TOLERANCE_M,
    SLOWDOWN_ABS_MIN_KMH,
    SLOWDOWN_RATIO_MAX,
)

PAIR = ["shape_key", "segment_index"]


def retained_bins(bins: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    return bins.filter(F.col("n_samples") >= min_samples)


def bundle_counts(bins: DataFrame, shapes: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Per bundle: bins, segments and shapes before and after the threshold."""
    kept = F.col("n_samples") >= min_samples
    pairs = bins.groupBy("bundle", *PAIR).agg(
        F.count(F.lit(1)).alias("bins"), F.count_if(kept).alias("kept_bins")
    )
    known = shapes.select("shape_key", F.lit(True).alias("known"))
    per_shape = (
        pairs.groupBy("bundle", "shape_key")
        .agg(
            F.sum("bins").alias("bins"),
            F.sum("kept_bins").alias("kept_bins"),
            F.count(F.lit(1)).alias("pairs"),
            F.count_if(F.col("kept_bins") > 0).alias("kept_pairs"),
        )
        .join(known, "shape_key", "left")
    )
    here = F.coalesce("known", F.lit(False)) & (F.col("kept_pairs") > 0)
    out = per_shape.groupBy("bundle").agg(
        F.sum("bins").alias("bins_before"),
        F.sum("kept_bins").alias("bins_after"),
        F.sum("pairs").alias("segments_before"),
        F.sum("kept_pairs").alias("segments_after"),
        F.sum(F.when(F.col("known").isNull(), F.col("kept_pairs")).otherwise(0)).alias("segments_missing"),
        F.count(F.lit(1)).alias("shapes_observed"),
        F.count_if(here).alias("shapes_written"),
    )

    def dropped_pct(before: str, after: str) -> Column:
        share = 100.0 * (F.col(before) - F.col(after)) / F.nullif(F.col(before), F.lit(0))
        return F.bround(share, 2)

    return out.withColumn("bins_dropped_pct", dropped_pct("bins_before", "bins_after")).withColumn(
        "segments_dropped_pct", dropped_pct("segments_before", "segments_after")
    )


def retained_segments(bins: DataFrame, shapes: DataFrame) -> DataFrame:
    """Distinct (bundle, shape_key, segment_index) whose shape is known."""
    pairs = bins.select("bundle", *PAIR).distinct()
    return pairs.join(shapes.select("shape_key"), "shape_key", "left_semi")


def unknown_segments(bins: DataFrame, shapes: DataFrame) -> DataFrame:
    pairs = bins.select("bundle", *PAIR).distinct()
    return pairs.join(shapes.select("shape_key"), "shape_key", "left_anti")


def _key_slice() -> Column:
    """Leading digits of a geometry key, a digest: up to 4,096 even slices of a bundle, in key order."""
    return F.substring("shape_key", 1, 3)


def index_segments(segments: DataFrame) -> DataFrame:
    """Zero-based segment_idx per bundle in (shape_key, segment_index) order.

    Numbered inside each slice of the keys, then shifted by the count of earlier slices.
    """
    numbered = running_sum_in_buckets(segments, ["bundle"], PAIR, _key_slice(), F.lit(1).cast("bigint"), "_nth")
    return numbered.withColumn("segment_idx", F.col("_nth") - 1).drop("_nth")


def slot_bins(bins: DataFrame, indexed: DataFrame) -> DataFrame:
    """(bundle, timeslot, segment_idx, speed_kmh, n_samples); bins without an index drop out."""
    kmh = F.rint(F.col("median_speed_ms") * KMH_PER_MS).cast("int")
    return bins.join(indexed.select("bundle", *PAIR, "segment_idx"), ["bundle", *PAIR]).select(
        "bundle", "timeslot", "segment_idx", kmh.alias("speed_kmh"), "n_samples"
    )


def segment_baseline(slots: DataFrame, min_slots: int = BASELINE_MIN_SLOTS) -> DataFrame:
    """Median of a segment's slot speeds, null under `min_slots`. A group has one row per slot."""
    enough = F.count(F.lit(1)) >= min_slots
    return slots.groupBy("bundle", "segment_idx").agg(
        F.count(F.lit(1)).alias("filled_slots"),
        F.when(enough, F.rint(F.median("speed_kmh"))).cast("int").alias("typical_kmh"),
    )


def slowdown(slot_kmh: Column, typical: Column) -> Column:
    slow = (slot_kmh <= SLOWDOWN_RATIO_MAX * typical) & (typical - slot_kmh >= SLOWDOWN_ABS_MIN_KMH)
    return F.coalesce(slow, F.lit(False))


def flag_slowdowns(slots: DataFrame, baseline: DataFrame) -> DataFrame:
    joined = slots.join(baseline, ["bundle", "segment_idx"], "left")
    return joined.withColumn(
        "is_slow", slowdown(F.col("speed_kmh").cast("double"), F.col("typical_kmh").cast("double"))
    )


def slot_documents(slots: DataFrame) -> DataFrame:
    """One row per (bundle, timeslot) with parallel arrays in segment order.

    The published document is one file per slot, so one slot of one network
    is its unit: at most one entry per road segment.
    """
    cell = F.struct("segment_idx", "speed_kmh", "n_samples")
    doc = slots.groupBy("bundle", "timeslot").agg(F.sort_array(F.collect_list(cell)).alias("c"))
    return doc.select(
        "bundle",
        "timeslot",
        F.col("c.segment_idx").alias("segment_idx"),
        F.col("c.speed_kmh").alias("speed_kmh"),
        F.col("c.n_samples").alias("n_samples"),
    )


def draw_paths(
    segments: DataFrame,
    shapes: DataFrame,
    segment_length_m: float = SEGMENT_LENGTH_M,
    tolerance_m: float = SIMPLIFY_TOLERANCE_M,
) -> DataFrame:
    """(shape_key, segment_index, points): each segment's simplified path.

    Segments are listed per shape before the join, so a line's arrays move
    once and not once per segment; a line's length bounds its list.
    """
    wanted = segments.groupBy("shape_key").agg(F.collect_set("segment_index").alias("wanted"))
    lines = wanted.join(shapes, "shape_key").select(
        "shape_key", "wanted", "xs", "ys", "cum_dist", "ref_lat_deg", "ref_lon"
    )
    cut = lines.mapInArrow(
        _cutter(segment_length_m, tolerance_m),
        "shape_key string, segment_index int, ref_lat_deg double, ref_lon double, "
        "xs array<double>, ys array<double>",
    )
    point = F.transform(
        F.arrays_zip("xs", "ys"),
        lambda p: F.struct(
            plane_lat(F.col("ref_lat_deg"), p["ys"]).alias("lat"),
            plane_lon(F.col("ref_lat_deg"), F.col("ref_lon"), p["xs"]).alias("lon"),
        ),
    )
    return cut.select(*PAIR, point.alias("points"))


def _cutter(segment_length_m: float, tolerance_m: float):
    names = ["shape_key", "segment_index", "ref_lat_deg", "ref_lon", "xs", "ys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key, wanted, *arrays, ref_lat, ref_lon = batch.columns
            cuts = []
            for i in range(batch.num_rows):
                x, y, cum = (a[i].values.to_numpy(zero_copy_only=False) for a in arrays)
                cuts.append(cut_line(x, y, cum, wanted[i].values.to_numpy(zero_copy_only=False), segment_length_m))
            points = np.concatenate([points for points, _ in cuts])
            sizes = np.concatenate([sizes for _, sizes in cuts])
            keep = kept_vertices(points, sizes, tolerance_m)
            first = np.cumsum(sizes) - sizes
            kept = np.add.reduceat(keep, first, dtype=np.int32) if len(first) else np.zeros(0, np.int32)
            offsets = pa.array(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32))
            thin = points[keep]
            line = pa.array(np.repeat(np.arange(batch.num_rows), [len(sizes) for _, sizes in cuts]))
            yield pa.RecordBatch.from_arrays(
                [
                    key.take(line),
                    wanted.flatten().cast(pa.int32()),
                    ref_lat.take(line),
                    ref_lon.take(line),
                    *[pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(thin[:, k]))) for k in (0, 1)],
                ],
                names=names,
            )

    return run


def cut_line(x, y, cum, index: np.ndarray, length_m: float) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of a line under its segments, one after the other, and the number of points of each.

    A stretch is its two ends and the vertices between them.
    """
    bounds = np.clip(np.stack([index, index + 1]) * length_m, 0.0, cum[-1])
    ends = np.stack([np.interp(bounds, cum, x), np.interp(bounds, cum, y)], axis=-1)
    first = np.searchsorted(cum, bounds[0], side="right")
    inner = np.maximum(np.searchsorted(cum, bounds[1], side="left") - first, 0)
    sizes = inner + 2
    last = np.cumsum(sizes) - 1
    points = np.empty((int(sizes.sum()), 2))
    points[last - sizes + 1], points[last] = ends
    between = np.ones(len(points), bool)
    between[last - sizes + 1] = between[last] = False
    source = _ranges(first, inner)
    points[between] = np.column_stack([x[source], y[source]])
    return points, sizes


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each first one on, one range after the other."""
    return np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def kept_vertices(points: np.ndarray, sizes: np.ndarray, tolerance_m: float) -> np.ndarray:
    """Mask of the points that a Douglas-Peucker pass over each of many lines keeps; ends always stay.

    All chords of a level are measured at once, and those that a vertex is too
    far from are split there for the next; a chord within the tolerance is done.
    """
    keep = np.zeros(len(points), dtype=bool)
    b = np.cumsum(sizes) - 1
    a = b - sizes + 1
    keep[a] = keep[b] = True
    while len(a):
        wide = b - a >= 2
        a, b = a[wide], b[wide]
        inner = b - a - 1
        at, chord = _ranges(a + 1, inner), np.repeat(np.arange(len(a)), inner)
        base, rel = (points[b] - points[a])[chord], points[at] - points[a][chord]
        len_sq = (base * base).sum(axis=1)
        along = np.divide((rel * base).sum(axis=1), len_sq, out=np.zeros(len(at)), where=len_sq > 0)
        off = np.hypot(*(rel - np.clip(along, 0.0, 1.0)[:, None] * base).T)
        most = np.maximum.reduceat(off, np.cumsum(inner) - inner) if len(a) else np.zeros(0)
        farthest = np.flatnonzero(off == most[chord])
        farthest = farthest[np.unique(chord[farthest], return_index=True)[1]]
        split = most > tolerance_m
        far, a, b = at[farthest][split], a[split], b[split]
        keep[far] = True
        a, b = np.concatenate([a, far]), np.concatenate([far, b])
    return keep


def keep_vertices(line: np.ndarray, tolerance_m: float) -> np.ndarray:
    """Mask of the vertices of one line that a Douglas-Peucker pass keeps."""
    return kept_vertices(line, np.array([len(line)]), tolerance_m)


def point_offsets(indexed_paths: DataFrame) -> DataFrame:
    """Add the running start offset of each segment's points per bundle."""
    summed = running_sum_in_buckets(
        indexed_paths, ["bundle"], ["segment_idx"], _key_slice(), F.size("points").cast("bigint"), "_upto"
    )
    return summed.withColumn("point_offset", F.col("_upto") - F.size("points")).drop("_upto")


def shape_table(segments: DataFrame, routes: DataFrame) -> DataFrame:
    """Dense zero-based shape_idx per bundle in key order, with what is known of each shape's routes.

    `routes` is `shape_routes`; a shape without a row there has empty lists and no type.
    """
    keys = segments.select("bundle", "shape_key").distinct()
    numbered = running_sum_in_buckets(
        keys, ["bundle"], ["shape_key"], _key_slice(), F.lit(1).cast("bigint"), "_nth"
    )
    none = F.array().cast("array<string>")
    known = numbered.join(routes, "shape_key", "left")
    return known.select(
        "bundle",
        (F.col("_nth") - 1).alias("shape_idx"),
        "shape_key",
        *[F.coalesce(name, none).alias(name) for name in ("shape_ids", "route_ids", "route_names")],
        "route_type",
    )


_SLICE = 4096  # rows of a bundle whose lists are made together


def _lists(rows: DataFrame, order: str, columns: dict[str, Column]) -> DataFrame:
    """One row per bundle with a flat list of each column, whose values are lists, in the order of a dense number.

    Lists of slices are made first and then put one after the other, so that a whole bundle is only ever
    held as its flat lists and not as a row object for each entry.
    """
    cells = F.struct(order, *[c for c in rows.columns if c not in ("bundle", order)])
    slices = rows.groupBy("bundle", F.floor(F.col(order) / _SLICE).alias("_slice")).agg(
        F.sort_array(F.collect_list(cells)).alias("s")
    )
    slices = slices.select("bundle", F.struct("_slice", *[values.alias(name) for name, values in columns.items()]).alias("part"))
    whole = slices.groupBy("bundle").agg(F.sort_array(F.collect_list("part")).alias("p"))
    return whole.select("bundle", *[F.flatten(F.col("p")[name]).alias(name) for name in columns])


def geometry_document(
    paths: DataFrame, table: DataFrame, baseline: DataFrame | None = None, segment_length_m: float = SEGMENT_LENGTH_M
) -> DataFrame:
    """One row per bundle: the shape table's columns, and for its segments flat lat, lon and point_offset arrays.

    `paths` are `point_offsets` rows, `table` is the `shape_table` of their bundles; a segment
    names its shape by shape_idx. The published document is one file per network; this is its writer only.
    """
    per_segment = ["shape_idx", "segment_index", "point_offset"]
    if baseline is not None:
        paths = paths.join(baseline.select("bundle", "segment_idx", "typical_kmh"), ["bundle", "segment_idx"], "left")
        per_segment.append("typical_kmh")
    placed = paths.join(table.select("bundle", "shape_key", "shape_idx"), ["bundle", "shape_key"])
    points = F.flatten(F.col("s.points"))
    listed = _lists(
        placed.select("bundle", "segment_idx", *per_segment, "points"),
        "segment_idx",
        {**{name: F.col(f"s.{name}") for name in per_segment}, "lat": points["lat"], "lon": points["lon"]},
    )
    if baseline is None:
        listed = listed.withColumn("typical_kmh", F.array_repeat(F.lit(None).cast("int"), F.size("segment_index")))
    per_shape = ["shape_key", "shape_ids", "route_ids", "route_names", "route_type"]
    shapes = _lists(table.select("bundle", "shape_idx", *per_shape), "shape_idx", {name: F.col(f"s.{name}") for name in per_shape})
    named = {name: f"shape_{name}" for name in ("route_ids", "route_names", "route_type")}
    shapes = shapes.withColumnsRenamed({"shape_key": "shape_keys", **named})
    return listed.join(shapes, "bundle").select(
        "bundle",
        F.lit(segment_length_m).alias("segment_length_m"),
        "shape_keys",
        "shape_ids",
        "shape_route_ids",
        "shape_route_names",
        "shape_route_type",
        "shape_idx",
        "segment_index",
        F.concat("point_offset", F.array(F.size("lat").cast("bigint"))).alias("point_offset"),
        "lat",
        "lon",
        "typical_kmh",
    )


def undrawable(slots: DataFrame, paths: DataFrame) -> DataFrame:
    """Slot rows whose segment has no path of two points or more; must be empty."""
    drawable = paths.filter(F.size("points") >= 2).select("bundle", "segment_idx")
    return slots.join(drawable, ["bundle", "segment_idx"], "left_anti")


def drawable_slots(slots: DataFrame, paths: DataFrame) -> DataFrame:
    """Each slot row with its polyline, from the flat table."""
    return slots.join(paths.select("bundle", "segment_idx", "points"), ["bundle", "segment_idx"])


def shape_routes(bridge: DataFrame, trips: DataFrame, routes: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Per geometry: its shape ids, route ids, names and single type or null.

    Routes of a shape id come from the newest snapshot that carries the id.
    """
    named = trips.filter(F.col("shape_id") != "").join(routes, ["snapshot", "route_id"])
    name = F.coalesce(F.nullif("route_short_name", F.lit("")), F.col("route_id"))
    # distinct first: thousands of trips of one route and shape say the same thing
    facts = named.select("snapshot", "shape_id", "route_id", name.alias("name"), "route_type").distinct()
    per_id = facts.groupBy("snapshot", "shape_id").agg(
        F.collect_set("route_id").alias("ids"),
        F.collect_set("name").alias("names"),
        F.when(F.count_distinct("route_type") == 1, F.max("route_type")).alias("type"),
    )
    newest = (
        per_id.join(snapshots.select("snapshot", "seq"), "snapshot")
        .groupBy("shape_id")
        .agg(F.max_by(F.struct("ids", "names", "type"), "seq").alias("r"))
    )
    return (
        bridge.join(newest, "shape_id", "left")
        .groupBy("shape_key")
        .agg(
            F.sort_array(F.collect_set("shape_id")).alias("shape_ids"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("r.ids")))).alias("route_ids"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("r.names")))).alias("route_names"),
            F.when(F.count_distinct("r.type") == 1, F.max("r.type")).cast("int").alias("route_type"),
        )
    )


def with_route_type(segments: DataFrame, routes_by_shape: DataFrame) -> DataFrame:
    typed = segments.join(routes_by_shape.select("shape_key", "route_type"), "shape_key", "left")
    return typed.withColumn("route_type", F.coalesce("route_type", F.lit(UNKNOWN_ROUTE_TYPE)))


def route_types_present(typed: DataFrame) -> DataFrame:
    return typed.groupBy("bundle", "route_type").agg(F.count(F.lit(1)).alias("segments")).withColumn(
        "label", route_type_label(F.col("route_type"))
    )


def enabled_segments(typed: DataFrame, enabled: list[int]) -> DataFrame:
    return typed.filter(F.col("route_type").isin(*enabled) if enabled else F.lit(False))


def incomplete_days(days: DataFrame, manifests: DataFrame) -> DataFrame:
    """Days of a bundle with a note why they are incomplete."""
    facts = manifests.select("service_date", "day_in_progress", "coverage_pct")
    # The note texts.
    open_day = (
        "day was still in progress when its own manifest was generated, not a closed calendar day"
    )
    thin = F.concat(F.lit("only "), F.col("coverage_pct").cast("string"), F.lit("% coverage of the calendar day"))
    note = F.when(F.col("day_in_progress"), open_day).when(
        F.col("coverage_pct") < INCOMPLETE_COVERAGE_PCT, thin
    )
    return days.join(facts, "service_date").withColumn("note", note).filter("note IS NOT NULL").drop(
        "day_in_progress", "coverage_pct"
    )


def drawn_incomplete(bundles: DataFrame) -> DataFrame:
    """Bundles with the incomplete days that really stand behind their median."""
    drawn = F.array_intersect("days_in_median", F.map_keys("incomplete_days"))
    return bundles.withColumn("drawn_incomplete", drawn).filter(F.size("drawn_incomplete") > 0)


def pick_slot(slots: Column, carried: Column, preferred: str = "08:00") -> Column:
    """Zero-based slot shown first: the carried one, else the preferred, else the first."""
    found = [F.nullif(F.array_position(slots, want), F.lit(0)) for want in (carried, F.lit(preferred))]
    return F.coalesce(*found, F.lit(1)) - 1
