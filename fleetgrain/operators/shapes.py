"""Route geometry: ordered points to plane coordinates, distances and keys."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgrain.functions.geo import haversine_m
from fleetgrain.functions.keys import KEY_HEX_CHARS, geometry_key
from fleetgrain.params import EARTH_RADIUS_M


def ordered_points(shape_points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, points ARRAY<STRUCT<lat, lon>>) in point order.

    A group is one published line, whose vertex count the feed bounds.
    """
    spots = F.sort_array(
        F.collect_list(F.struct("shape_pt_sequence", "shape_pt_lat", "shape_pt_lon"))
    )
    return shape_points.groupBy(*keys).agg(
        F.transform(
            spots, lambda p: F.struct(p["shape_pt_lat"].alias("lat"), p["shape_pt_lon"].alias("lon"))
        ).alias("points")
    )


def keyed_points(shape_points: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered points with their geometry key, written in Python where its digits are the same beyond doubt."""
    ordered = ordered_points(shape_points, keys)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
    keyed = ordered.mapInArrow(_with_clear_keys, f"{schema}, clear_key string")
    return keyed.withColumn("shape_key", F.coalesce("clear_key", geometry_key(F.col("points")))).drop("clear_key")


def _with_clear_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `geometry_key`, null for a line with a coordinate near a tie of its sixth decimal, of 1,000 or more or none."""
    for batch in batches:
        points = batch.column(batch.num_columns - 1)
        lat, lon = (a.to_numpy(zero_copy_only=False) for a in points.flatten().flatten())
        ends = np.cumsum(points.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        clear = np.ones(len(lat), bool)
        for values in (lat, lon):
            size = np.abs(values)
            # a double below 1,000 times 1e6 is off by far less than 1e-6
            with np.errstate(invalid="ignore"):
                clear &= (size < 1000) & (np.abs(size * 1e6 % 1 - 0.5) > 1e-6)
        doubts = np.concatenate([[0], np.cumsum(~clear)])
        made, first = [], 0
        for end in ends:
            text = None
            if doubts[end] == doubts[first]:
                text = ";".join(map("%.6f,%.6f".__mod__, zip(lat[first:end].tolist(), lon[first:end].tolist(), strict=True)))
            made.append(text if text is None else hashlib.sha256(text.encode()).hexdigest()[:KEY_HEX_CHARS])
            first = end
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, "clear_key"])


def shape_bridge(keyed: DataFrame) -> DataFrame:
    """Distinct (shape_key, shape_id) over every snapshot."""
    return keyed.select("shape_key", "shape_id").distinct()


def build_shapes(keyed: DataFrame) -> DataFrame:
    """One row per geometry with at least two points: plane arrays and distances.

    The reference point is the mean latitude and the first longitude.
    """
    distinct = keyed.filter(F.size("points") >= 2).groupBy("shape_key").agg(
        F.any_value("points").alias("points")
    )
    lines = distinct.select("shape_key", F.col("points.lat").alias("lats"), F.col("points.lon").alias("lons"))
    return lines.mapInArrow(
        _measure,
        "shape_key string, xs array<double>, ys array<double>, cum_dist array<double>, "
        "ref_lat_deg double, ref_lon double",
    )


_POINTS = 1 << 16  # points measured at once; one line may have more


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of each line, some lines at a time."""
    for batch in batches:
        ends = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
        lo = 0
        while lo < batch.num_rows:
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(ends.searchsorted(done + _POINTS, "right")))
            yield _vectors(batch.slice(lo, hi - lo))
            lo = hi


def _vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
    keys, lats, lons = batch.columns
    lat, lon = (a.flatten().to_numpy(zero_copy_only=False) for a in (lats, lons))
    sizes = lats.value_lengths().to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    first = cuts[:-1]
    lines = [slice(a, b) for a, b in zip(first.tolist(), cuts[1:].tolist())]
    ref_lat, ref_lon = np.array([lat[line].mean() for line in lines]), lon[first]
    phi, lam = np.radians(lat), np.radians(lon)
    h = np.sin((phi[1:] - phi[:-1]) / 2) ** 2
    h += np.cos(phi[1:]) * np.cos(phi[:-1]) * np.sin((lam[1:] - lam[:-1]) / 2) ** 2
    cum = np.concatenate([[0.0], 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(h))])
    cum[first] = 0.0  # not the hop from the line before
    for line in lines:
        np.cumsum(cum[line], out=cum[line])
    xs = np.radians(lon - np.repeat(ref_lon, sizes)) * np.repeat(np.cos(np.radians(ref_lat)), sizes) * EARTH_RADIUS_M
    ys = np.radians(lat - np.repeat(ref_lat, sizes)) * EARTH_RADIUS_M
    lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(values)) for values in (xs, ys, cum)]
    names = ["shape_key", "xs", "ys", "cum_dist", "ref_lat_deg", "ref_lon"]
    return pa.RecordBatch.from_arrays([keys, *lists, pa.array(ref_lat), pa.array(ref_lon)], names=names)


def vertex_distances(shape_points: DataFrame, keys: list[str]) -> DataFrame:
    """Long form of the same: each vertex with its distance along the line."""
    order = Window.partitionBy(*keys).orderBy("shape_pt_sequence")
    lat, lon = F.col("shape_pt_lat"), F.col("shape_pt_lon")
    hop = F.coalesce(
        haversine_m(F.lag(lat).over(order), F.lag(lon).over(order), lat, lon), F.lit(0.0)
    )
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return shape_points.withColumn("_hop", hop).withColumn(
        "cum_dist", F.sum("_hop").over(upto)
    ).drop("_hop")


def identity_conflicts(bridge: DataFrame) -> DataFrame:
    """How often an id names several geometries and a geometry several ids."""
    by_id = bridge.groupBy("shape_id").agg(F.count_distinct("shape_key").alias("keys"))
    by_key = bridge.groupBy("shape_key").agg(F.count_distinct("shape_id").alias("ids"))
    return (
        by_id.select("keys", F.lit(None).cast("bigint").alias("ids"))
        .unionByName(by_key.select(F.lit(None).cast("bigint").alias("keys"), "ids"))
        .agg(
            F.count_if(F.col("keys") > 1).alias("multi_geometry_shape_ids"),
            F.count_if(F.col("ids") > 1).alias("multi_id_geometries"),
        )
    )


def network_extent(stops: DataFrame, shape_points: DataFrame, margin: float) -> DataFrame:
    """Extent of stops and lines together, and the padded box around it."""
    spots = stops.select(
        F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon")
    ).unionByName(
        shape_points.select(F.col("shape_pt_lat").alias("lat"), F.col("shape_pt_lon").alias("lon"))
    )
    ext = spots.agg(
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"),
        F.max("lon").alias("lon_max"),
    )
    return ext.select(
        "*",
        (F.col("lat_min") - margin).alias("box_lat_min"),
        (F.col("lat_max") + margin).alias("box_lat_max"),
        (F.col("lon_min") - margin).alias("box_lon_min"),
        (F.col("lon_max") + margin).alias("box_lon_max"),
    )
