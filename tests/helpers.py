"""Small inputs whose answers are known by hand."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from fleetgrain.operators import shapes as shape_ops
from fleetgrain.operators import walk
from fleetgrain.params import WalkParams
from fleetgrain.session import cut_lineage

HOP_M = math.radians(0.001) * 6371000
DAY = dt.date(2026, 9, 1)
TZ = "Europe/Athens"

FIX = "vehicle_id string, trip_id string, snapshot_ts bigint, lat double, lon double, speed_ms double"


def line_points(spark, shape_id="S1", lats=11, lat0=0.0, lon=0.0):
    rows = [(shape_id, i, lat0 + 0.001 * i, lon) for i in range(lats)]
    schema = "shape_id string, shape_pt_sequence int, shape_pt_lat double, shape_pt_lon double"
    return spark.createDataFrame(rows, schema)


_LINE = {}


def line_shapes(spark):
    if spark not in _LINE:
        keyed = shape_ops.keyed_points(line_points(spark), ["shape_id"])
        _LINE[spark] = (cut_lineage(shape_ops.build_shapes(keyed)), keyed.first()["shape_key"])
    return _LINE[spark]


def plan_and_trips(spark, trips, day=DAY):
    """Day plan over feeds a then b, and trips given as (trip, route, shape id, shape key)."""
    plan = spark.createDataFrame([(day, "a", "b")], "service_date date, snapshot string, next_snapshot string")
    schema = "snapshot string, trip_id string, route_id string, shape_id string, shape_key string"
    return plan, spark.createDataFrame([("a", *t) for t in trips], schema)


def fixes(spark, rows, day=DAY):
    """rows of (ts, lat[, lon[, speed[, vehicle[, trip]]]])."""
    full = []
    for row in rows:
        ts, lat, lon, speed, vehicle, trip = (*row, *(0.0, None, "V1", "T1")[len(row) - 2 :])
        full.append((vehicle, trip, ts, lat, lon, speed))
    df = spark.createDataFrame(full, FIX).coalesce(1)
    return df.withColumn("service_date", F.lit(day)).withColumn("seq", F.monotonically_increasing_id())


def walk_line(spark, rows, params=None, **kwargs):
    shapes, key = line_shapes(spark)
    plan, trips = plan_and_trips(spark, [("T1", "R1", "S1", key)])
    params = params or WalkParams(timezone=TZ)
    return walk.walk(fixes(spark, rows), plan, trips, shapes, params, ["seq"], **kwargs)


def rejects(steps):
    rows = walk.outcomes(steps).collect()
    return {r["verdict"]: r["records"] for r in rows if r["verdict"] not in (walk.HEAD, walk.ACCEPTED)}


# --- an independent, fix-by-fix walk in plain Python, for comparison only


def plain_project(shape, lat, lon, lo, hi):
    px = math.radians(lon - shape["ref_lon"]) * math.cos(math.radians(shape["ref_lat_deg"])) * 6371000
    py = math.radians(lat - shape["ref_lat_deg"]) * 6371000
    best = None
    for i in range(lo, hi + 1):
        ax, ay = shape["xs"][i], shape["ys"][i]
        dx, dy = shape["xs"][i + 1] - ax, shape["ys"][i + 1] - ay
        size = dx * dx + dy * dy
        t = min(max(((px - ax) * dx + (py - ay) * dy) / size, 0), 1) if size else 0
        off = math.hypot(px - ax - t * dx, py - ay - t * dy)
        if best is None or off < best[0] - 1e-9:
            best = (off, shape["cum_dist"][i] + t * (shape["cum_dist"][i + 1] - shape["cum_dist"][i]))
    return best[1]


def plain_walk(shape, records, p):
    """[(ts, verdict, dist)] for records sorted by time."""
    cum, out, prev, last = shape["cum_dist"], [], None, None
    n = len(cum)
    for ts, lat, lon in records:
        gap = None if prev is None else ts - prev
        if gap is not None and 0 < gap < p.min_gap_sec:
            out.append((ts, "gap_too_short", None))
            continue
        if gap is None or gap <= 0 or gap > p.max_gap_sec:
            dist = plain_project(shape, lat, lon, 0, n - 2)
            verdict = "walk_start" if gap is None else (
                "non_positive_time_delta" if gap <= 0 else "gap_too_large"
            )
        else:
            low = last - p.backward_tolerance_m - p.search_margin_m
            high = last + p.max_speed_ms * gap + p.search_margin_m
            lo = max(0, sum(c < low for c in cum) - 1)
            hi = max(lo, min(n - 2, sum(c <= high for c in cum)))
            dist = plain_project(shape, lat, lon, lo, hi)
            delta = dist - last
            verdict = (
                "moved_backward"
                if delta < -p.backward_tolerance_m
                else "speed_too_high" if delta / gap > p.max_speed_ms else "accepted"
            )
        out.append((ts, verdict, dist))
        prev, last = ts, dist
    return out


def random_trip(seed, size=120):
    """A looping line and noisy fixes along it, with ties, silences and jumps."""
    rng = random.Random(seed)
    points, lat, lon = [], 42.6, 23.3
    for i in range(80):
        points.append((lat, lon))
        turn = i * 0.15 + rng.uniform(-0.4, 0.4)
        lat += 0.0006 * math.sin(turn)
        lon += 0.0008 * math.cos(turn)
    ts, at, records = 1_790_000_000, 0.0, []
    for _ in range(size):
        ts += rng.choice([0, 0, 5, 20, 22, 23, 45, 45, 46, 90, 300, 650])
        at = min(max(at + rng.choice([-1.5, -0.2, 0, 0.5, 1, 2, 6]), 0), 78.99)
        i, f = int(at), at % 1
        (a, b), (c, d) = points[i], points[i + 1]
        records.append(
            (ts, a + f * (c - a) + rng.gauss(0, 0.0002), b + f * (d - b) + rng.gauss(0, 0.0002))
        )
    return points, records
