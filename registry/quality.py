"""Queries over polls, day quality and ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

import driver_views as views
from fleetgrain.operators import quality, shapes
from fleetgrain.params import BBOX_MARGIN_DEG
from fleetgrain.sources import jsonl, profiles

MULTIPLIER = 10.0

# Percentages round half to even, as the rule for day records says.
POLLS = f"""
sec AS (
  SELECT *, CAST(floor(epoch(ts) / 4) AS BIGINT) + 1278000000 AS snapshot_ts FROM events),
data AS (
  SELECT *, CAST(timezone('{views.TZ}', to_timestamp(snapshot_ts)) AS DATE) AS service_date
  FROM sec),
polls AS (
  SELECT service_date, snapshot_ts, event_type <> 'error' AS fetch_ok,
         CAST(floor(value) AS BIGINT) % 3 AS vehicle_count, event_id % 9 + 2 AS entities_total,
         event_id % 9 + 1 AS vehicles_with_position, event_id % 2 AS dropped_out_of_bbox
  FROM data WHERE day(service_date) % 4 <> 1
   AND NOT (day(service_date) % 3 = 0 AND (snapshot_ts + 7200) % 86400 < 21600)),
starts AS (
  SELECT d.service_date, first_data, first_beat,
         CASE WHEN first_beat IS NOT NULL THEN first_beat - first_data > 120 END AS heartbeat_partial
  FROM (SELECT service_date, min(snapshot_ts) AS first_data FROM data GROUP BY 1) d
  LEFT JOIN (SELECT service_date, min(snapshot_ts) AS first_beat FROM polls GROUP BY 1) b USING (service_date)),
times AS (
  SELECT service_date, snapshot_ts, heartbeat_partial FROM polls JOIN starts USING (service_date)
  WHERE NOT heartbeat_partial
  UNION ALL
  SELECT DISTINCT service_date, snapshot_ts, heartbeat_partial FROM polls JOIN starts USING (service_date)
  WHERE heartbeat_partial
  UNION ALL
  SELECT DISTINCT service_date, snapshot_ts, heartbeat_partial FROM data JOIN starts USING (service_date)
  WHERE first_beat IS NULL OR (heartbeat_partial AND snapshot_ts < first_beat)),
win AS (
  SELECT service_date, start_ts, last_ts, polls, {views.NOW} < stop AS day_in_progress,
         CASE WHEN {views.NOW} < stop THEN {views.NOW} - last_ts END AS local_lag_sec,
         CASE WHEN {views.NOW} < stop THEN last_ts + 45 ELSE stop END AS end_ts
  FROM (SELECT service_date, max(snapshot_ts) AS last_ts, count(*) AS polls,
               CAST(epoch(timezone('{views.TZ}', CAST(service_date AS TIMESTAMP))) AS BIGINT) AS start_ts,
               CAST(epoch(timezone('{views.TZ}', CAST(service_date + 1 AS TIMESTAMP))) AS BIGINT) AS stop
        FROM times GROUP BY service_date))
"""


def poll_outcomes(spark, sf_dir):
    return quality.poll_outcomes(views.polls(spark, sf_dir))


OUTCOMES_SQL = f"""WITH {POLLS}
SELECT service_date, count(*) AS polls_logged, count(CASE WHEN fetch_ok THEN 1 END) AS successful_polls,
       count(CASE WHEN fetch_ok AND vehicle_count = 0 THEN 1 END) AS empty_polls, count(CASE WHEN NOT fetch_ok THEN 1 END) AS fetch_error_polls,
       CAST(sum(entities_total) AS BIGINT) AS entities_total, CAST(sum(vehicles_with_position) AS BIGINT) AS vehicles_with_position,
       CAST(sum(dropped_out_of_bbox) AS BIGINT) AS dropped_out_of_bbox,
       round(100.0e0 * sum(dropped_out_of_bbox) / sum(vehicles_with_position), 3) AS dropped_out_of_bbox_pct
FROM polls GROUP BY service_date"""


def _times(spark, sf_dir):
    return quality.poll_times(views.polls(spark, sf_dir), views.poll_data(spark, sf_dir))


def _windows(spark, sf_dir):
    days = views.poll_data(spark, sf_dir).select("service_date").distinct()
    return quality.day_windows(days, views.TZ, F.lit(views.NOW))


def heartbeat_reconciliation(spark, sf_dir):
    return _times(spark, sf_dir).groupBy("service_date", "heartbeat_partial").agg(
        F.sum("polls").alias("polls"), F.count(F.lit(1)).alias("stamps"), F.min("snapshot_ts").alias("first_ts")
    )


RECONCILED_SQL = f"""WITH {POLLS}
SELECT service_date, heartbeat_partial, count(*) AS polls, count(DISTINCT snapshot_ts) AS stamps,
       min(snapshot_ts) AS first_ts
FROM times GROUP BY ALL"""


def poll_gaps(spark, sf_dir):
    return quality.poll_gaps(_times(spark, sf_dir), _windows(spark, sf_dir), views.POLL_INTERVAL, MULTIPLIER)


GAPS_SQL = f"""WITH {POLLS},
marks AS (
  SELECT service_date, snapshot_ts AS t FROM times
  UNION SELECT service_date, start_ts FROM win UNION SELECT service_date, end_ts FROM win)
SELECT service_date, after_ts, t AS before_ts, t - after_ts AS gap_seconds
FROM (SELECT *, lag(t) OVER (PARTITION BY service_date ORDER BY t) AS after_ts FROM marks)
WHERE t - after_ts > 450"""


def poll_coverage(spark, sf_dir):
    return quality.coverage(_times(spark, sf_dir), _windows(spark, sf_dir), views.POLL_INTERVAL)


COVERAGE_SQL = f"""WITH {POLLS}
SELECT service_date, day_in_progress, polls, local_lag_sec, end_ts - start_ts AS day_seconds,
       round_even((end_ts - start_ts) / 45.0e0, 1) AS expected_polls,
       round_even(100.0e0 * polls / ((end_ts - start_ts) / 45.0e0), 2) AS coverage_pct
FROM win"""


def observed_interval(spark, sf_dir):
    return quality.observed_interval(_times(spark, sf_dir))


INTERVAL_SQL = f"""WITH {POLLS}
SELECT service_date, median(step) AS observed_interval_sec
FROM (SELECT service_date,
             snapshot_ts - lag(snapshot_ts) OVER (PARTITION BY service_date ORDER BY snapshot_ts) AS step
      FROM times) GROUP BY service_date"""


def day_manifests(spark, sf_dir):
    """The assembled quality record per day; digests stand in from the day's own counts."""
    data = views.poll_data(spark, sf_dir)
    digests = data.groupBy("service_date").agg(
        F.sha2(F.count(F.lit(1)).cast("string"), 256).alias("data_sha256")
    )
    out = quality.day_manifests(
        data,
        views.polls(spark, sf_dir),
        digests,
        views.TZ,
        F.lit(views.NOW),
        views.POLL_INTERVAL,
        MULTIPLIER,
    )
    return out.select(
        "service_date",
        "total_vehicle_records",
        "day_in_progress",
        "coverage_pct",
        "gap_count",
        F.aggregate("gaps", F.lit(0).cast("bigint"), lambda a, g: a + g["gap_seconds"]).alias("gap_seconds"),
        "heartbeat_partial",
        "polls_logged",
        "data_sha256",
    )


MANIFESTS_SQL = f"""WITH {POLLS},
marks AS (
  SELECT service_date, snapshot_ts AS t FROM times
  UNION SELECT service_date, start_ts FROM win UNION SELECT service_date, end_ts FROM win),
gaps AS (
  SELECT service_date, count(*) AS gap_count, sum(gap) AS gap_seconds
  FROM (SELECT service_date, t - lag(t) OVER (PARTITION BY service_date ORDER BY t) AS gap FROM marks)
  WHERE gap > 450 GROUP BY service_date)
SELECT d.service_date, d.n AS total_vehicle_records, day_in_progress,
       round_even(100.0e0 * polls / ((end_ts - start_ts) / 45.0e0), 2) AS coverage_pct,
       CAST(coalesce(gap_count, 0) AS INTEGER) AS gap_count, CAST(coalesce(gap_seconds, 0) AS BIGINT) AS gap_seconds,
       heartbeat_partial, p.n AS polls_logged, sha256(CAST(d.n AS VARCHAR)) AS data_sha256
FROM (SELECT service_date, count(*) AS n FROM data GROUP BY 1) d JOIN win USING (service_date)
JOIN starts USING (service_date) LEFT JOIN gaps USING (service_date)
LEFT JOIN (SELECT service_date, count(*) AS n FROM polls GROUP BY 1) p USING (service_date)"""


def network_extent(spark, sf_dir):
    stops = views.table(spark, sf_dir, "supplier").select(
        (F.lit(42.0) + F.col("s_acctbal") / 100000).alias("stop_lat"),
        (F.lit(19.99) + F.col("s_nationkey") * 0.01).alias("stop_lon"),
    )
    out = shapes.network_extent(stops, views.shape_points(spark, sf_dir), BBOX_MARGIN_DEG)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


EXTENT_SQL = """WITH p AS (
  SELECT 42.0e0 + s_acctbal / 100000 AS lat, 19.99e0 + s_nationkey * 0.01e0 AS lon FROM supplier
  UNION ALL
  SELECT 42.5e0 + degrees(i * (5000.0e0 + (c_custkey % 40) * 100) / 6371000.0e0), 20.0e0 + c_custkey * 0.0005e0
  FROM customer, range(60) r(i) WHERE c_custkey % 13 <> 5)
SELECT round(min(lat), 6) AS lat_min, round(max(lat), 6) AS lat_max, round(min(lon), 6) AS lon_min,
       round(max(lon), 6) AS lon_max, round(min(lat) - 0.04e0, 6) AS box_lat_min,
       round(max(lat) + 0.04e0, 6) AS box_lat_max, round(min(lon) - 0.04e0, 6) AS box_lon_min,
       round(max(lon) + 0.04e0, 6) AS box_lon_max
FROM p"""


def shape_distances(spark, sf_dir):
    """Distance along the line at every vertex."""
    points = shapes.vertex_distances(views.shape_points(spark, sf_dir), ["snapshot", "shape_id"])
    return points.select("shape_id", "shape_pt_sequence", F.round("cum_dist", 3).alias("cum_dist"))


DISTANCES_SQL = """SELECT 'S' || c_custkey AS shape_id, CAST(i AS INTEGER) AS shape_pt_sequence,
  round(i * (5000.0e0 + (c_custkey % 40) * 100), 3) AS cum_dist
FROM customer, range(60) r(i) WHERE c_custkey % 13 <> 5"""


def shape_identity(spark, sf_dir):
    """Ids with several geometries and geometries with several ids, over three feeds."""
    points = views.shape_points(spark, sf_dir)
    key = F.substring("shape_id", 2, 20).cast("bigint")
    copied = points.filter(key % 20 == 0).withColumn("shape_id", F.concat(F.lit("C"), key.cast("string")))
    moved = points.filter(key % 30 == 1).withColumn("shape_pt_lat", F.col("shape_pt_lat") + 0.05)
    feeds = points.unionByName(copied.withColumn("snapshot", F.lit("s2"))).unionByName(
        moved.withColumn("snapshot", F.lit("s3"))
    )
    keyed = shapes.keyed_points(feeds, ["snapshot", "shape_id"])
    return shapes.identity_conflicts(shapes.shape_bridge(keyed))


IDENTITY_SQL = """SELECT count(CASE WHEN c_custkey % 30 = 1 THEN 1 END) AS multi_geometry_shape_ids,
  count(CASE WHEN c_custkey % 20 = 0 THEN 1 END) AS multi_id_geometries FROM customer WHERE c_custkey % 13 <> 5"""

ENTITIES = """
e AS (
  SELECT *, CAST(floor(epoch(ts) / 1200) AS BIGINT) * 300 + 1278000000 AS poll_ts,
         42.0e0 + user_id % 150 * 0.0101234567e0 AS lat, 23.0e0 + event_id % 100 * 0.0101234567e0 AS lon,
         event_id % 11 <> 0 AS has_vehicle, event_id % 11 <> 0 AND event_id % 7 <> 0 AS placed
  FROM events),
x AS (SELECT *, placed AND lat BETWEEN 42.1 AND 43.2 AND lon BETWEEN 23.05 AND 23.8 AS inside FROM e)
"""


def vehicle_entities(spark, sf_dir):
    """Decoded entities as records, kept when inside the box."""
    records = jsonl.vehicle_records(views.decoded_polls(spark, sf_dir))
    out = jsonl.records_inside(records, views.box())
    return out.select("snapshot_ts", "vehicle_id", "route_id", "trip_id", "lat", "lon", "bearing", "speed_ms",
                      "vehicle_ts", "current_status", "schedule_relationship")


VEHICLES_SQL = f"""WITH {ENTITIES}
SELECT poll_ts AS snapshot_ts, CAST(user_id AS VARCHAR) AS vehicle_id,
       CASE WHEN event_id % 5 <> 0 THEN event_type END AS route_id,
       CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS trip_id,
       round(lat, 6) AS lat, round(lon, 6) AS lon, CAST(NULL AS DOUBLE) AS bearing, round(value / 7, 2) AS speed_ms,
       CAST(floor(epoch(ts)) AS BIGINT) AS vehicle_ts, 'IN_TRANSIT_TO' AS current_status,
       CASE WHEN event_id % 5 <> 0 THEN 'SCHEDULED' END AS schedule_relationship
FROM x WHERE inside"""


def poll_audit(spark, sf_dir):
    return jsonl.poll_audit(views.decoded_polls(spark, sf_dir), views.box())


AUDIT_SQL = f"""WITH {ENTITIES}
SELECT poll_ts AS snapshot_ts, true AS fetch_ok, count(CASE WHEN inside THEN 1 END) AS vehicle_count,
       count(CASE WHEN has_vehicle THEN 1 END) AS entities_total, count(CASE WHEN placed THEN 1 END) AS vehicles_with_position,
       count(CASE WHEN placed THEN 1 END) - count(CASE WHEN inside THEN 1 END) AS dropped_out_of_bbox
FROM x GROUP BY poll_ts"""


def torn_lines(spark, sf_dir):
    """Tolerant parse of the event properties, every seventh line cut short."""
    events = views.table(spark, sf_dir, "events")
    cut = F.when(F.col("event_id") % 7 == 3, F.expr("left(props, length(props) - 2)")).otherwise(F.col("props"))
    lines = events.select("event_type", cut.alias("line"))
    parsed = jsonl.parse_lines(lines, "line", "k BIGINT, _corrupt_record STRING")
    torn = F.col("record._corrupt_record").isNotNull()
    return parsed.groupBy("event_type").agg(
        F.count_if(~torn).alias("records"), F.count_if(torn).alias("malformed"), F.sum("record.k").alias("total")
    )


TORN_SQL = """SELECT event_type, count(CASE WHEN event_id % 7 <> 3 THEN 1 END) AS records, count(CASE WHEN event_id % 7 = 3 THEN 1 END) AS malformed,
  CAST(sum(CASE WHEN event_id % 7 <> 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END) AS BIGINT) AS total
FROM events GROUP BY event_type"""


def city_violations(spark, sf_dir):
    """City parameters drawn from customers by nation, some of them broken."""
    customers = views.table(spark, sf_dir, "customer")
    n = F.col("c_nationkey")
    cities = customers.groupBy("c_nationkey").agg(
        F.min("c_acctbal").alias("lat_min"), F.max("c_acctbal").alias("lat_max")
    )
    return quality.city_violations(
        cities.select(
            n.cast("string").alias("slug"),
            F.when(n % 5 == 0, F.col("lat_max")).otherwise(F.col("lat_min")).alias("lat_min"),
            "lat_max",
            F.lit(1.0).alias("lon_min"),
            F.when(n % 7 == 2, 0.5).otherwise(2.0).alias("lon_max"),
            F.when(n % 4 == 1, "mph").otherwise("kmh").alias("speed_field_unit"),
            F.when(n % 6 != 0, "UTC").alias("timezone"),
            (n % 8).alias("poll_interval_sec"),
            F.lit("positions").alias("positions_feed"),
            F.when(n % 9 != 3, "static").otherwise("").alias("static_feed"),
            F.lit("CC0").alias("licence"),
        )
    )


CITIES_SQL = """WITH c AS (SELECT DISTINCT c_nationkey AS n FROM customer),
v AS (
  SELECT n, unnest(list_filter([
    CASE WHEN n % 5 = 0 THEN 'latitude edges out of order' END,
    CASE WHEN n % 7 = 2 THEN 'longitude edges out of order' END,
    CASE WHEN n % 4 = 1 THEN 'unknown speed field unit' END,
    CASE WHEN n % 6 = 0 THEN 'no timezone' END,
    CASE WHEN n % 8 = 0 THEN 'no poll interval' END,
    CASE WHEN n % 9 = 3 THEN 'no static feed' END], lambda p: p IS NOT NULL)) AS problem FROM c)
SELECT CAST(n AS VARCHAR) AS slug, problem FROM v"""


def profile_violations(spark, sf_dir):
    """A profile document per customer, nested JSON, some of them broken in one or several places."""
    key = F.col("c_custkey")

    def unless(broken, column):
        return F.when(~broken, column)

    def stated(name, text):
        return F.concat(F.lit(f'"{name}":"'), text, F.lit('"'))

    def block(*parts):
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    licences = block(
        unless(key % 11 == 1, F.lit('"vehicle_positions":"CC BY"')), F.lit('"static":"CC0"')
    )
    attribution = block(
        stated("source_name", F.col("c_name")),
        stated("licence", F.when(key % 17 == 3, "").otherwise("CC BY")),
        F.concat(F.lit('"feed_licences":'), F.when(key % 13 == 2, F.lit('"CC BY"')).otherwise(licences)),
    )
    lat = F.concat(F.lit('"lat_min":'), F.when(key % 19 == 4, "43").otherwise("42.5"))
    box = block(lat, F.lit('"lat_max":43'), unless(key % 23 == 5, F.lit('"lon_min":23')), F.lit('"lon_max":24'))
    feeds = block(F.lit('"vehicle_positions":"u"'), F.when(key % 29 == 6, '"static":null').otherwise('"static":"v"'))
    text = block(
        stated("slug", F.when(key % 31 == 7, "other").otherwise(key.cast("string"))),
        stated("name", F.col("c_name")),
        F.lit('"timezone":"UTC"'),
        unless(key % 37 == 8, F.lit('"poll_interval_sec":45')),
        F.concat(F.lit('"bbox":'), box),
        unless(key % 41 == 9, F.concat(F.lit('"feeds":'), feeds)),
        unless(key % 43 == 10, F.concat(F.lit('"attribution":'), attribution)),
        stated("speed_field_unit", F.when(key % 7 == 3, "mph").otherwise("ms")),
        F.when(key % 5 == 1, F.lit('"auth":{"kind":"header"}')),
    )
    torn = F.when(key % 47 == 11, F.substring(text, 1, 40)).otherwise(text)
    files = views.table(spark, sf_dir, "customer").select(key.cast("string").alias("slug"), torn.alias("text"))
    return profiles.profile_violations(files)


VIOLATIONS_SQL = """WITH v AS (
  SELECT c_custkey AS k, unnest(CASE WHEN k % 47 = 11 THEN ['not a JSON object'] ELSE list_filter([
    CASE WHEN k % 31 = 7 THEN 'declares another slug than its file name' END,
    CASE WHEN k % 37 = 8 THEN 'missing required key poll_interval_sec' END,
    CASE WHEN k % 41 = 9 THEN 'missing required key feeds' END,
    CASE WHEN k % 43 = 10 THEN 'missing required key attribution' END,
    CASE WHEN k % 23 = 5 THEN 'bbox is missing lon_min' END,
    CASE WHEN k % 19 = 4 THEN 'bbox has lat_min at or above lat_max' END,
    CASE WHEN k % 29 = 6 AND k % 41 <> 9 THEN 'no static feed' END,
    CASE WHEN k % 7 = 3 THEN 'unknown speed field unit' END,
    CASE WHEN k % 17 = 3 AND k % 43 <> 10 THEN 'attribution is missing licence' END,
    CASE WHEN k % 13 = 2 AND k % 43 <> 10 THEN 'attribution has no feed_licences map' END,
    CASE WHEN k % 11 = 1 AND k % 13 <> 2 AND k % 43 <> 10 THEN 'no licence stated for the vehicle_positions feed' END,
    CASE WHEN k % 5 = 1 THEN 'auth names no environment variable' END], lambda p: p IS NOT NULL) END) AS problem
  FROM customer)
SELECT CAST(k AS VARCHAR) AS slug, problem FROM v"""


QUERIES = {
    "profile_violations": (profile_violations, VIOLATIONS_SQL),
    "poll_outcomes": (poll_outcomes, OUTCOMES_SQL),
    "heartbeat_reconciliation": (heartbeat_reconciliation, RECONCILED_SQL),
    "poll_gaps": (poll_gaps, GAPS_SQL),
    "poll_coverage": (poll_coverage, COVERAGE_SQL),
    "observed_interval": (observed_interval, INTERVAL_SQL),
    "day_manifests": (day_manifests, MANIFESTS_SQL),
    "network_extent": (network_extent, EXTENT_SQL),
    "shape_distances": (shape_distances, DISTANCES_SQL),
    "shape_identity": (shape_identity, IDENTITY_SQL),
    "vehicle_entities": (vehicle_entities, VEHICLES_SQL),
    "poll_audit": (poll_audit, AUDIT_SQL),
    "torn_lines": (torn_lines, TORN_SQL),
    "city_violations": (city_violations, CITIES_SQL),
}
