"""Great-circle and plane geometry as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetgrain.params import COORD_DECIMALS, EARTH_RADIUS_M


def _half_sine_sq(degrees: Column) -> Column:
    s = F.sin(F.radians(degrees) / 2)
    return s * s


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    h = _half_sine_sq(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * _half_sine_sq(lon2 - lon1)
    return F.asin(F.sqrt(h)) * (2 * EARTH_RADIUS_M)


def plane_x(ref_lat: Column, ref_lon: Column, lon: Column) -> Column:
    return F.radians(lon - ref_lon) * F.cos(F.radians(ref_lat)) * F.lit(EARTH_RADIUS_M)


def plane_y(ref_lat: Column, lat: Column) -> Column:
    return F.radians(lat - ref_lat) * F.lit(EARTH_RADIUS_M)


def plane_lat(ref_lat: Column, y: Column) -> Column:
    return F.bround(ref_lat + F.degrees(y / F.lit(EARTH_RADIUS_M)), COORD_DECIMALS)


def plane_lon(ref_lat: Column, ref_lon: Column, x: Column) -> Column:
    scale = F.cos(F.radians(ref_lat)) * F.lit(EARTH_RADIUS_M)
    return F.bround(ref_lon + F.degrees(x / scale), COORD_DECIMALS)


def onto_segment(
    px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column
) -> Column:
    """struct(fraction, distance) of a point's foot on a segment."""
    dx, dy = bx - ax, by - ay
    len_sq = dx * dx + dy * dy
    along = ((px - ax) * dx + (py - ay) * dy) / F.nullif(len_sq, F.lit(0.0))
    frac = F.coalesce(F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    return F.struct(
        frac.alias("fraction"),
        F.hypot(px - (ax + frac * dx), py - (ay + frac * dy)).alias("distance"),
    )


def inside_box(lat: Column, lon: Column, box: Column) -> Column:
    """Inclusive bounding-box test; `box` is struct(lat_min, lat_max, lon_min, lon_max)."""
    return lat.between(box["lat_min"], box["lat_max"]) & lon.between(
        box["lon_min"], box["lon_max"]
    )


def segment_index(dist_m: Column, segment_length_m: float) -> Column:
    return F.floor(dist_m / F.lit(float(segment_length_m))).cast("int")


def along_shape(cum: Column, coords: Column, dist_m: Column) -> Column:
    """Coordinate at a distance along a polyline, clamped to its ends."""
    top = F.element_at(cum, -1)
    d = F.greatest(F.lit(0.0), F.least(dist_m, top))
    passed = F.size(F.filter(cum, lambda c: c <= d))
    i = F.greatest(F.lit(1), F.least(passed, F.size(cum) - 1))
    start, end = F.element_at(cum, i), F.element_at(cum, i + 1)
    frac = F.coalesce((d - start) / F.nullif(end - start, F.lit(0.0)), F.lit(0.0))
    a, b = F.element_at(coords, i), F.element_at(coords, i + 1)
    return a + frac * (b - a)
