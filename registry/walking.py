"""Queries over the trip walk and its samples."""

from __future__ import annotations

from pyspark.sql import functions as F

import driver_views as views
from fleetgrain.operators import bins, walk
from fleetgrain.operators.shapes import build_shapes
from registry.common import judged_steps, stage, steps, walk_plan, walk_shapes, walk_trips

# Events as fixes, walked fix by fix; the same arithmetic as driver_views.
FIXES = """
ev AS (
  SELECT event_id, user_id, value,
         CAST(floor(epoch(ts) / 1200) AS BIGINT) * 300 + 1278000000 AS snapshot_ts
  FROM events),
pos AS (
  SELECT *, DATE '1970-01-01' + CAST(snapshot_ts // 86400 AS INTEGER) AS service_date,
         event_id % 89 <> 0 AS has_trip, event_id % 97 <> 0 AS has_vehicle,
         (snapshot_ts % 86400) * 1.0037117283e0 + (event_id % 13) * 1200.1173911e0 AS dist
  FROM ev),
lookup AS (
  SELECT c_custkey, c_mktsegment AS route_id, c_custkey % 10 = 3 AS from_next,
         c_custkey % 13 <> 5 AS has_shape
  FROM customer WHERE c_custkey % 17 <> 4),
keyed AS (
  SELECT p.*, l.route_id, l.from_next, l.c_custkey IS NOT NULL AS known,
         coalesce(l.has_shape, false) AS has_shape
  FROM pos p LEFT JOIN lookup l ON l.c_custkey = p.user_id
  WHERE has_trip AND has_vehicle),
f AS (
  SELECT *, row_number() OVER (PARTITION BY service_date, user_id ORDER BY snapshot_ts, event_id) AS rn
  FROM keyed WHERE known AND has_shape),
w AS (
  SELECT service_date, user_id, rn, snapshot_ts, value, route_id, dist,
         snapshot_ts AS anchor_ts, dist AS anchor_dist,
         'walk_start' AS verdict, CAST(NULL AS BIGINT) AS from_ts, CAST(NULL AS DOUBLE) AS delta
  FROM f WHERE rn = 1
  UNION ALL
  SELECT f.service_date, f.user_id, f.rn, f.snapshot_ts, f.value, f.route_id, f.dist,
         CASE WHEN f.snapshot_ts > w.anchor_ts AND f.snapshot_ts - w.anchor_ts < 2500
              THEN w.anchor_ts ELSE f.snapshot_ts END,
         CASE WHEN f.snapshot_ts > w.anchor_ts AND f.snapshot_ts - w.anchor_ts < 2500
              THEN w.anchor_dist ELSE f.dist END,
         CASE WHEN f.snapshot_ts > w.anchor_ts AND f.snapshot_ts - w.anchor_ts < 2500 THEN 'gap_too_short'
              WHEN f.snapshot_ts <= w.anchor_ts THEN 'non_positive_time_delta'
              WHEN f.snapshot_ts - w.anchor_ts > 20000 THEN 'gap_too_large'
              WHEN f.dist - w.anchor_dist < -5000 THEN 'moved_backward'
              WHEN (f.dist - w.anchor_dist) / (f.snapshot_ts - w.anchor_ts) > 10 / 3.6e0 THEN 'speed_too_high'
              ELSE 'accepted' END,
         w.anchor_ts, f.dist - w.anchor_dist
  FROM w JOIN f ON f.service_date = w.service_date AND f.user_id = w.user_id AND f.rn = w.rn + 1)
"""
GEOMETRY = """
line AS (
  SELECT c_custkey, i, 42.5e0 + degrees(i * (5000.0e0 + (c_custkey % 40) * 100) / 6371000.0e0) AS lat,
         20.0e0 + c_custkey * 0.0005e0 AS lon
  FROM customer, range(60) r(i) WHERE c_custkey % 13 <> 5),
geo AS (
  SELECT c_custkey, sha256(string_agg(printf('%.6f,%.6f', lat, lon), ';' ORDER BY i))[1:16] AS shape_key
  FROM line GROUP BY c_custkey)
"""
SAMPLES = """
s AS (
  SELECT w.service_date, w.route_id, CAST(w.user_id AS VARCHAR) AS trip_id, g.shape_key,
         CAST(floor(w.dist / 20000) AS INTEGER) AS segment_index,
         strftime(time_bucket(INTERVAL '15 minutes', timezone('Europe/Athens', to_timestamp(w.snapshot_ts))),
                  '%H:%M') AS timeslot,
         w.delta / (w.snapshot_ts - w.from_ts) AS speed_raw,
         round(w.delta / (w.snapshot_ts - w.from_ts), 3) AS speed_ms,
         round(w.delta, 1) AS dist_m, w.snapshot_ts - w.from_ts AS dt_sec,
         w.value AS feed_speed_kmh, w.from_ts, w.snapshot_ts AS to_ts
  FROM w JOIN geo g ON g.c_custkey = w.user_id WHERE w.verdict = 'accepted')
"""
DAYS = """
days AS (
  SELECT service_date, CASE WHEN isodow(service_date) < 6
         THEN strftime(date_trunc('week', service_date), '%Y-%m-%d') END AS period_key
  FROM (SELECT DISTINCT service_date FROM pos))
"""
BINS = """
bins AS (
  SELECT period_key, shape_key, segment_index, timeslot,
         round(median(speed_raw), 3) AS median_speed_ms, count(*) AS n_samples
  FROM s JOIN days USING (service_date) WHERE period_key IS NOT NULL
  GROUP BY ALL)
"""
_S = f"WITH RECURSIVE {FIXES}, {GEOMETRY}, {SAMPLES}"
_B = f"{_S}, {DAYS}, {BINS}"


def _samples(spark, sf_dir):
    return walk.samples(steps(spark, sf_dir), views.WALK)


def trip_walk(spark, sf_dir):
    """The whole walk from raw tables; other queries read its stored steps."""
    return judged_steps(spark, sf_dir).select(
        "service_date",
        "vehicle_id",
        "snapshot_ts",
        F.col("n").alias("records"),
        "verdict",
        "from_ts",
        F.round("dist_m", 3).alias("dist_m"),
        F.round("delta_m", 3).alias("delta_m"),
    )


TRIP_WALK_SQL = f"""WITH RECURSIVE {FIXES},
judged AS (
  SELECT service_date, user_id, snapshot_ts, rn, verdict, from_ts, dist, delta FROM w
  UNION ALL
  SELECT service_date, user_id, snapshot_ts, event_id,
         CASE WHEN known THEN 'shape_not_found' ELSE 'trip_not_in_static' END, NULL, NULL, NULL
  FROM keyed WHERE NOT (known AND has_shape)),
step AS (
  SELECT service_date, CAST(user_id AS VARCHAR) AS vehicle_id, snapshot_ts, count(*) AS records,
         arg_min(verdict, rn) AS verdict, min(rn) AS rn
  FROM judged GROUP BY ALL)
SELECT step.service_date, step.vehicle_id, step.snapshot_ts, step.records, step.verdict, j.from_ts,
       CASE WHEN step.verdict <> 'gap_too_short' THEN round(j.dist, 3) END AS dist_m,
       CASE WHEN step.verdict NOT IN ('gap_too_short', 'gap_too_large') THEN round(j.delta, 3) END AS delta_m
FROM step JOIN judged j ON CAST(j.user_id AS VARCHAR) = step.vehicle_id
 AND j.service_date = step.service_date AND j.snapshot_ts = step.snapshot_ts AND j.rn = step.rn"""


def trip_walk_bent(spark, sf_dir):
    """The walk on lines that come back beside themselves, where the search window decides."""
    # trips and shapes both start from the lines, which are long in making
    lines = stage(spark, sf_dir, "bent_lines", views.bent_lines)
    trips = views.trips(spark, sf_dir, lines)
    seen = views.bent_positions(spark, sf_dir)
    judged = walk.walk(seen, walk_plan(spark, sf_dir), trips, build_shapes(lines), views.BENT, ["seq"])
    return judged.select(
        "service_date",
        "vehicle_id",
        "snapshot_ts",
        F.col("n").alias("records"),
        "verdict",
        "from_ts",
        F.round("dist_m", 3).alias("dist_m"),
        F.round("delta_m", 3).alias("delta_m"),
    )


# Every fix on every segment of its line, then fix by fix the nearest one that the window holds.
TRIP_WALK_BENT_SQL = f"""WITH RECURSIVE {FIXES.split("f AS (")[0].rstrip().rstrip(",")},
line AS (
  SELECT c_custkey, i,
         42.5e0 + degrees(least(i, 149 - i) * (42000.0e0 / 74 + (c_custkey % 40) * 5) / 6371000.0e0) AS lat,
         20.0e0 + c_custkey * 0.0005e0 + CASE WHEN i < 75 THEN 0.0e0 ELSE 0.0101e0 END + (i % 2) * 0.0007e0 AS lon
  FROM customer, range(150) r(i) WHERE c_custkey % 13 <> 5),
hop AS (
  SELECT *, avg(lat) OVER (PARTITION BY c_custkey) AS ref_lat,
         first_value(lon) OVER (PARTITION BY c_custkey ORDER BY i) AS ref_lon,
         coalesce(2 * 6371000.0e0 * asin(sqrt(
           sin((radians(lat) - radians(lag(lat) OVER o)) / 2) ^ 2 + cos(radians(lat)) * cos(radians(lag(lat) OVER o))
           * sin((radians(lon) - radians(lag(lon) OVER o)) / 2) ^ 2)), 0) AS m
  FROM line WINDOW o AS (PARTITION BY c_custkey ORDER BY i)),
vertex AS (
  SELECT *, radians(lon - ref_lon) * cos(radians(ref_lat)) * 6371000.0e0 AS x, radians(lat - ref_lat) * 6371000.0e0 AS y,
         sum(m) OVER (PARTITION BY c_custkey ORDER BY i) AS cum
  FROM hop),
seg AS (
  SELECT * FROM (SELECT *, lead(x) OVER o - x AS dx, lead(y) OVER o - y AS dy, lead(cum) OVER o - cum AS span
                 FROM vertex WINDOW o AS (PARTITION BY c_custkey ORDER BY i)) WHERE span IS NOT NULL),
cums AS (SELECT c_custkey, list(cum ORDER BY i) AS cums FROM vertex GROUP BY c_custkey),
spot AS (
  SELECT *, 42.5e0 + degrees(CASE WHEN dist < 42000 THEN dist ELSE 84000.0e0 - dist END / 6371000.0e0) AS lat,
         20.0e0 + user_id * 0.0005e0 + (event_id % 7) * 0.0020173e0 AS lon
  FROM keyed WHERE known AND has_shape),
rel AS (
  SELECT spot.event_id, seg.*, radians(spot.lon - ref_lon) * cos(radians(ref_lat)) * 6371000.0e0 - x AS px,
         radians(spot.lat - ref_lat) * 6371000.0e0 - y AS py
  FROM spot JOIN seg ON seg.c_custkey = spot.user_id),
foot AS (
  SELECT *, greatest(0, least(1, (px * dx + py * dy) / (dx * dx + dy * dy))) AS frac FROM rel),
feet AS (
  SELECT event_id, list(struct_pack(off := (px - frac * dx) ^ 2 + (py - frac * dy) ^ 2, i := i,
                                    along := cum + frac * span) ORDER BY i) AS feet
  FROM foot GROUP BY event_id),
f AS (
  SELECT spot.*, feet, cums, list_min(feet).along AS free,
         row_number() OVER (PARTITION BY service_date, user_id ORDER BY snapshot_ts, event_id) AS rn
  FROM spot JOIN feet USING (event_id) JOIN cums ON cums.c_custkey = spot.user_id),
w AS (
  SELECT service_date, user_id, rn, snapshot_ts, snapshot_ts AS anchor_ts, free AS anchor_dist, 'walk_start' AS verdict,
         CAST(NULL AS BIGINT) AS from_ts, free AS dist, CAST(NULL AS DOUBLE) AS delta
  FROM f WHERE rn = 1
  UNION ALL
  SELECT service_date, user_id, rn, snapshot_ts,
         CASE WHEN short THEN anchor_ts ELSE snapshot_ts END, CASE WHEN short THEN anchor_dist ELSE d END,
         CASE WHEN short THEN 'gap_too_short'
              WHEN gap <= 0 THEN 'non_positive_time_delta'
              WHEN gap > 20000 THEN 'gap_too_large'
              WHEN d - anchor_dist < -5000 THEN 'moved_backward'
              WHEN (d - anchor_dist) / gap > 10 / 3.6e0 THEN 'speed_too_high'
              ELSE 'accepted' END,
         anchor_ts, d, d - anchor_dist
  FROM (SELECT *, gap > 0 AND gap < 2500 AS short,
               CASE WHEN gap <= 0 OR gap > 20000 THEN free ELSE list_min([v FOR v IN feet IF v.i >= lo AND v.i <= hi]).along END AS d
        FROM (SELECT f.*, w.anchor_ts, w.anchor_dist, f.snapshot_ts - w.anchor_ts AS gap,
                     least(148, greatest(0, len([c FOR c IN cums IF c < w.anchor_dist - 9000]) - 1)) AS lo,
                     greatest(0, len([c FOR c IN cums IF c <= w.anchor_dist + 10 / 3.6e0 * (f.snapshot_ts - w.anchor_ts) + 4000])) AS hi
              FROM w JOIN f ON f.service_date = w.service_date AND f.user_id = w.user_id AND f.rn = w.rn + 1))),
{TRIP_WALK_SQL.split(FIXES + ",")[1].lstrip()}"""


def speed_samples(spark, sf_dir):
    out = _samples(spark, sf_dir)
    return out.drop("vehicle_id", "shape_id").withColumn("speed_raw", F.round("speed_raw", 6))


SPEED_SAMPLES_SQL = f"{_S} SELECT * REPLACE (round(speed_raw, 6) AS speed_raw) FROM s"


def typical_weekday_bins(spark, sf_dir):
    return bins.typical_bins(_samples(spark, sf_dir), walk_plan(spark, sf_dir))


TYPICAL_SQL = f"{_B} SELECT * FROM bins"


def day_speed_bins(spark, sf_dir):
    out = bins.day_bins(_samples(spark, sf_dir))
    return out.withColumn("median_speed_ms", F.round("median_speed_ms", 5))


DAY_BINS_SQL = f"""{_S}
SELECT service_date, shape_key, segment_index, timeslot, round(median(speed_ms), 5) AS median_speed_ms,
       count(*) AS n_samples
FROM s GROUP BY ALL"""


def walk_reject_counters(spark, sf_dir):
    outcomes = walk.outcomes(steps(spark, sf_dir)).unionByName(
        walk.keyless_records(views.positions(spark, sf_dir))
    )
    return bins.day_counters(outcomes)


COUNTERS_SQL = f"""WITH RECURSIVE {FIXES},
judged AS (
  SELECT service_date, verdict FROM w
  UNION ALL
  SELECT service_date, CASE WHEN known THEN 'shape_not_found' ELSE 'trip_not_in_static' END
  FROM keyed WHERE NOT (known AND has_shape)
  UNION ALL
  SELECT service_date, 'trip_not_in_static' FROM pos WHERE NOT (has_trip AND has_vehicle))
SELECT service_date, count(*) AS records,
       count(CASE WHEN verdict = 'walk_start' THEN 1 END) AS walks,
       count(CASE WHEN verdict NOT IN ('walk_start', 'shape_not_found', 'trip_not_in_static') THEN 1 END) AS pairs,
       count(CASE WHEN verdict = 'accepted' THEN 1 END) AS samples,
       count(CASE WHEN verdict = 'trip_not_in_static' THEN 1 END) AS trip_not_in_static,
       count(CASE WHEN verdict = 'shape_not_found' THEN 1 END) AS shape_not_found, 0 AS position_unusable,
       count(CASE WHEN verdict = 'gap_too_short' THEN 1 END) AS gap_too_short,
       count(CASE WHEN verdict = 'non_positive_time_delta' THEN 1 END) AS non_positive_time_delta,
       count(CASE WHEN verdict = 'gap_too_large' THEN 1 END) AS gap_too_large,
       count(CASE WHEN verdict = 'moved_backward' THEN 1 END) AS moved_backward,
       count(CASE WHEN verdict = 'speed_too_high' THEN 1 END) AS speed_too_high
FROM judged GROUP BY ROLLUP (service_date)"""


def unusable_fixes(spark, sf_dir):
    """Positions with gaps in their coordinates; what is left is walked, and every fix is counted once."""
    seen = views.torn_positions(spark, sf_dir)
    dims = walk_plan(spark, sf_dir), walk_trips(spark, sf_dir), walk_shapes(spark, sf_dir)
    judged = walk.walk(seen, *dims, views.WALK, ["seq"])
    outcomes = walk.outcomes(judged).unionByName(walk.keyless_records(seen)).unionByName(walk.unusable_fixes(seen))
    return bins.day_counters(outcomes).select("service_date", "records", "position_unusable")


UNUSABLE_SQL = f"""WITH RECURSIVE {FIXES}, torn AS (
  SELECT service_date, has_trip AND has_vehicle AND (event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 107 = 0) AS bad
  FROM pos)
SELECT service_date, count(*) AS records, count(CASE WHEN bad THEN 1 END) AS position_unusable
FROM torn GROUP BY ROLLUP (service_date)"""


def feed_speed_check(spark, sf_dir):
    return bins.feed_speed_validation(_samples(spark, sf_dir), views.VALIDATION_KMH)


VALIDATION_SQL = f"""{_S}, d AS (SELECT abs(speed_raw * 3.6e0 - feed_speed_kmh) AS diff FROM s)
SELECT count(*) AS n_compared, round(median(diff), 3) AS median_abs_diff_kmh,
       round(100.0e0 * count(CASE WHEN diff > 100 THEN 1 END) / count(*), 3) AS pct_over_threshold
FROM d"""


def next_feed_resolution(spark, sf_dir):
    return walk.next_feed_counts(
        views.positions(spark, sf_dir), walk_plan(spark, sf_dir), walk_trips(spark, sf_dir)
    )


NEXT_FEED_SQL = f"""WITH RECURSIVE {FIXES}
SELECT service_date, count(*) AS records_from_next_feed, count(DISTINCT user_id) AS trips_from_next_feed
FROM pos JOIN lookup ON c_custkey = user_id WHERE has_trip AND lookup.from_next GROUP BY service_date"""


def typical_bin_totals(spark, sf_dir):
    return bins.bin_totals(bins.typical_keys(_samples(spark, sf_dir), walk_plan(spark, sf_dir)))


BIN_TOTALS_SQL = f"""{_B}
SELECT count(*) AS segment_count, count(DISTINCT (shape_key, segment_index, timeslot)) AS distinct_segment_count
FROM bins"""


QUERIES = {
    "typical_weekday_bins": (typical_weekday_bins, TYPICAL_SQL),
    "trip_walk": (trip_walk, TRIP_WALK_SQL),
    "trip_walk_bent": (trip_walk_bent, TRIP_WALK_BENT_SQL),
    "speed_samples": (speed_samples, SPEED_SAMPLES_SQL),
    "day_speed_bins": (day_speed_bins, DAY_BINS_SQL),
    "walk_reject_counters": (walk_reject_counters, COUNTERS_SQL),
    "unusable_fixes": (unusable_fixes, UNUSABLE_SQL),
    "feed_speed_check": (feed_speed_check, VALIDATION_SQL),
    "next_feed_resolution": (next_feed_resolution, NEXT_FEED_SQL),
    "typical_bin_totals": (typical_bin_totals, BIN_TOTALS_SQL),
}
