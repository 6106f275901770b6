"""Queries over timetables, snapshots and schedule periods."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

import driver_views as views
from fleetgrain.functions.clock import is_weekday
from fleetgrain.operators import reconcile, serve
from fleetgrain.plans import calendar, periods, snapshots

TOLERANCE_PCT = 22.0
CITY = ["city"]

# The order timetable; the same arithmetic as driver_views.
TIMETABLE = """
trip AS (
  SELECT o_orderstatus AS city, o_orderpriority AS route_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS service_date,
         strftime(o_orderdate, '%Y-%m-') || CAST(o_orderkey % 3 AS VARCHAR) AS service_id
  FROM orders),
day AS (
  SELECT DISTINCT city, service_date FROM trip
  UNION ALL
  SELECT city, CAST(max(service_date) + INTERVAL 1 MONTH AS DATE) FROM trip GROUP BY city),
sched AS (
  SELECT city, service_date, route_id, count(*) AS trips
  FROM trip WHERE NOT suffix(service_id, '-09-2') GROUP BY ALL),
sig AS (
  SELECT day.city, day.service_date, CAST(coalesce(sum(trips), 0) AS BIGINT) AS trip_count,
         sha256(coalesce(string_agg(route_id || ',' || trips, ';' ORDER BY route_id), ''))[1:16] AS signature_key
  FROM day LEFT JOIN sched USING (city, service_date) GROUP BY ALL),
level AS (
  SELECT city, median(trip_count) AS level FROM sig
  WHERE isodow(service_date) < 6 AND trip_count > 0 GROUP BY city),
judged AS (
  SELECT sig.*, level,
         CASE WHEN isodow(service_date) >= 6 THEN 'weekend'
              WHEN trip_count = 0 THEN 'no_calendar_rows'
              WHEN trip_count < level * 80 / 100 THEN 'reduced_service' END AS excluded_from_median
  FROM sig LEFT JOIN level USING (city))
"""
# Distances between all kept days, then the fold with the list of openers as state.
FOLD = f"""
kept AS (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY service_date) AS rn
  FROM judged WHERE excluded_from_median IS NULL),
routes AS (SELECT DISTINCT city, route_id FROM sched),
cell AS (
  SELECT k.city, k.rn, r.route_id, coalesce(s.trips, 0) AS trips
  FROM kept k JOIN routes r USING (city) LEFT JOIN sched s USING (city, service_date, route_id)),
apart AS (
  SELECT a.city, a.rn, list(d ORDER BY b_rn) AS dists FROM (
    SELECT a.city, a.rn, b.rn AS b_rn, CAST(sum(abs(a.trips - b.trips)) AS BIGINT) AS d
    FROM cell a JOIN cell b USING (city, route_id) GROUP BY ALL) a GROUP BY ALL),
lim AS (SELECT city, list(trip_count * {TOLERANCE_PCT} / 100 ORDER BY rn) AS limits FROM kept GROUP BY city),
fold AS (
  SELECT city, CAST(1 AS BIGINT) AS rn, [CAST(1 AS BIGINT)] AS openers, CAST(1 AS BIGINT) AS cur
  FROM kept WHERE rn = 1
  UNION ALL
  SELECT city, rn, CASE WHEN pick IS NULL THEN list_append(openers, rn) ELSE openers END,
         coalesce(pick, rn)
  FROM (
    SELECT f.city, a.rn, f.openers,
           CASE WHEN a.dists[f.cur] <= l.limits[f.cur] THEN f.cur
                ELSE list_sort(list_transform(
                       list_filter(f.openers, lambda o: a.dists[o] <= l.limits[o]),
                       lambda o: {{'d': a.dists[o], 'o': -o}}))[1].o * -1 END AS pick
    FROM fold f JOIN apart a ON a.city = f.city AND a.rn = f.rn + 1 JOIN lim l ON l.city = f.city)),
assigned AS (
  SELECT k.city, k.service_date, k.trip_count, k.signature_key, o.signature_key AS period_key,
         o.service_date AS period_reference_date, a.dists[f.cur] AS churn_vs_reference
  FROM fold f JOIN kept k USING (city, rn) JOIN kept o ON o.city = f.city AND o.rn = f.cur
  JOIN apart a ON a.city = f.city AND a.rn = f.rn)
"""


def _signed(spark, sf_dir):
    days = views.order_days(spark, sf_dir).withColumn("snapshot", F.col("city"))
    services = calendar.active_services(views.order_calendar(spark, sf_dir))
    trips = views.order_trips(spark, sf_dir)
    return calendar.signatures(days, calendar.scheduled_trips(days, services, trips)).drop("snapshot")


def schedule_signatures(spark, sf_dir):
    return _signed(spark, sf_dir).select(
        "city", "service_date", "trip_count", "signature_key", F.size("counts").alias("route_count")
    )


SIGNATURES_SQL = f"""WITH {TIMETABLE}
SELECT sig.*, CAST((SELECT count(*) FROM sched s WHERE s.city = sig.city AND s.service_date = sig.service_date)
                   AS INTEGER) AS route_count
FROM sig"""


def day_exclusions(spark, sf_dir):
    return periods.exclusions(_signed(spark, sf_dir), CITY).select(
        "city", "service_date", "trip_count", F.round("level", 3).alias("level"), "excluded_from_median"
    )


EXCLUSIONS_SQL = f"""WITH {TIMETABLE}
SELECT city, service_date, trip_count, round(level, 3) AS level, excluded_from_median FROM judged"""


def _assigned(spark, sf_dir):
    return periods.assign_periods(_signed(spark, sf_dir), CITY, TOLERANCE_PCT)


def schedule_periods(spark, sf_dir):
    return _assigned(spark, sf_dir).select(
        "city",
        "service_date",
        "excluded_from_median",
        "period_key",
        "churn_vs_reference",
        "period_reference_date",
    )


PERIODS_SQL = f"""WITH RECURSIVE {TIMETABLE}, {FOLD}
SELECT j.city, j.service_date, j.excluded_from_median, a.period_key, a.churn_vs_reference,
       a.period_reference_date
FROM judged j LEFT JOIN assigned a USING (city, service_date)"""


def period_summaries(spark, sf_dir):
    none = spark.createDataFrame([], "period_key string, bin_count bigint")
    out = periods.period_summary(_assigned(spark, sf_dir), none, CITY)
    return out.select(
        "city",
        "period_key",
        "reference_date",
        F.size("days_in_median").alias("days"),
        "first_date",
        "last_date",
        "route_count",
        "trip_count",
        "max_churn_vs_reference",
    )


SUMMARY_SQL = f"""WITH RECURSIVE {TIMETABLE}, {FOLD}
SELECT a.city, period_key, arg_min(period_reference_date, service_date) AS reference_date, CAST(count(*) AS INTEGER) AS days,
       min(service_date) AS first_date, max(service_date) AS last_date,
       CAST(arg_min((SELECT count(*) FROM sched s WHERE s.city = a.city AND s.service_date = a.service_date),
                    service_date) AS INTEGER) AS route_count,
       arg_min(trip_count, service_date) AS trip_count, max(churn_vs_reference) AS max_churn_vs_reference
FROM assigned a GROUP BY a.city, period_key"""


def current_period(spark, sf_dir):
    none = spark.createDataFrame([], "period_key string, bin_count bigint")
    return periods.current_period(periods.period_summary(_assigned(spark, sf_dir), none, CITY), CITY)


CURRENT_SQL = f"""WITH RECURSIVE {TIMETABLE}, {FOLD},
p AS (SELECT city, period_key, count(*) AS n, max(service_date) AS last FROM assigned GROUP BY ALL)
SELECT city, arg_max(period_key, (n, last)) AS current_period FROM p GROUP BY city"""


def period_index(spark, sf_dir):
    """Index of each city's periods, with the days that no median holds."""
    assigned = _assigned(spark, sf_dir)
    none = spark.createDataFrame([], "period_key string, bin_count bigint")
    summary = periods.period_summary(assigned, none, CITY).withColumnRenamed("period_key", "bundle")
    current = periods.current_period(summary.withColumnRenamed("bundle", "period_key"), CITY)
    marked = summary.join(current, CITY, "left").withColumn("is_current", F.col("bundle") == F.col("current_period"))
    document = reconcile.index_document(marked.drop("current_period"), assigned, CITY)
    return document.select(
        "city",
        "current_period",
        "period_count",
        F.array_join(F.transform("periods", lambda p: F.concat_ws(" ", p["first_date"].cast("string"), p["bundle"])), ",").alias("periods"),
        F.array_join(
            F.transform("days_excluded_from_median", lambda d: F.concat_ws(" ", d["date"].cast("string"), d["reason"])), ","
        ).alias("days_excluded"),
    )


PERIOD_INDEX_SQL = f"""WITH RECURSIVE {TIMETABLE}, {FOLD},
p AS (SELECT city, period_key, count(*) AS n, min(service_date) AS first_date, max(service_date) AS last FROM assigned GROUP BY ALL),
listed AS (
  SELECT city, arg_max(period_key, (n, last)) AS current_period, CAST(count(*) AS INTEGER) AS period_count,
         string_agg(CAST(first_date AS VARCHAR) || ' ' || period_key, ',' ORDER BY first_date, period_key) AS periods
  FROM p GROUP BY city),
out AS (
  SELECT city, string_agg(CAST(service_date AS VARCHAR) || ' ' || excluded_from_median, ',' ORDER BY service_date) AS days_excluded
  FROM judged WHERE excluded_from_median IS NOT NULL GROUP BY city)
SELECT city, current_period, coalesce(period_count, 0) AS period_count, coalesce(periods, '') AS periods,
       coalesce(days_excluded, '') AS days_excluded
FROM listed FULL JOIN out USING (city)"""


def schedule_churn(spark, sf_dir):
    """Trips between each network day and the one before it."""
    days = views.order_days(spark, sf_dir).withColumn("snapshot", F.col("city"))
    services = calendar.active_services(views.order_calendar(spark, sf_dir))
    sched = calendar.scheduled_trips(days, services, views.order_trips(spark, sf_dir)).drop("snapshot")
    order = Window.partitionBy("city").orderBy("service_date")  # one row per day
    links = days.select("city", "service_date", F.lag("service_date").over(order).alias("before")).filter(
        "before IS NOT NULL"
    )
    before = sched.withColumnRenamed("service_date", "before").join(links, ["city", "before"])
    keys = ["city", "service_date"]
    left = sched.join(links, keys).select(*keys, "route_id", "trips")
    return calendar.churn(left, before.select(*keys, "route_id", "trips"), keys)


CHURN_SQL = f"""WITH {TIMETABLE},
link AS (SELECT city, service_date, lag(service_date) OVER (PARTITION BY city ORDER BY service_date) AS before
         FROM day),
a AS (SELECT l.city, l.service_date, route_id, trips FROM link l JOIN sched USING (city, service_date)
      WHERE before IS NOT NULL),
b AS (SELECT l.city, l.service_date, route_id, trips FROM link l
      JOIN sched s ON s.city = l.city AND s.service_date = l.before)
SELECT city, service_date, CAST(sum(abs(coalesce(a.trips, 0) - coalesce(b.trips, 0))) AS BIGINT) AS churn
FROM a FULL JOIN b USING (city, service_date, route_id) GROUP BY ALL"""

FILES = """
file AS (
  SELECT o_orderpriority AS city,
         CASE WHEN o_orderkey % 10 < 2 THEN 'gtfs_' || strftime(o_orderdate, '%Y-%m-%d') || '.zip'
              WHEN o_orderkey % 10 < 3 THEN 'gtfs_' || strftime(o_orderdate, '%Y-%m-%d') || 'T'
                   || lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || '00.zip'
              ELSE 'gtfs_' || strftime(o_orderdate, '%Y-%m-%d') || '.zip.part' END AS name
  FROM orders),
snap AS (
  SELECT city, name AS snapshot, CAST(name[6:15] AS DATE) AS snap_date,
         CAST(row_number() OVER (PARTITION BY city ORDER BY name) AS INTEGER) AS seq,
         lead(name) OVER (PARTITION BY city ORDER BY name) AS next_snapshot
  FROM (SELECT DISTINCT city, name FROM file
        WHERE regexp_matches(name, '^gtfs_[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9]{4})?[.]zip$')))
"""


def snapshot_catalogue(spark, sf_dir):
    return snapshots.catalogue(views.snapshot_files(spark, sf_dir), CITY)


CATALOGUE_SQL = f"WITH {FILES} SELECT * FROM snap"


def _every_order_day(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    rows = orders.select(F.col("o_orderpriority").alias("city"), day.alias("service_date"))
    first = rows.groupBy("city").agg(F.date_sub(F.min("service_date"), 3).alias("service_date"))
    return rows.distinct().unionByName(first)


def snapshot_as_of(spark, sf_dir):
    catalogue = snapshots.catalogue(views.snapshot_files(spark, sf_dir), CITY)
    out = snapshots.as_of(_every_order_day(spark, sf_dir), catalogue, CITY)
    return out.withColumn("is_weekday", is_weekday(F.col("service_date")))


AS_OF_SQL = f"""WITH {FILES},
day AS (
  SELECT DISTINCT o_orderpriority AS city, CAST(o_orderdate AS DATE) AS service_date FROM orders
  UNION ALL
  SELECT o_orderpriority, CAST(min(o_orderdate) - INTERVAL 3 DAY AS DATE) FROM orders GROUP BY 1),
ranked AS (
  SELECT d.city, d.service_date, s.snapshot, row_number() OVER (
           PARTITION BY d.city, d.service_date
           ORDER BY s.snap_date DESC, CASE WHEN s.snap_date = d.service_date THEN seq ELSE -seq END) AS rk
  FROM day d JOIN snap s ON s.city = d.city AND s.snap_date <= d.service_date),
picked AS (
  SELECT d.city, d.service_date, coalesce(r.snapshot, e.snapshot) AS snapshot, r.snapshot IS NULL AS is_fallback
  FROM day d LEFT JOIN ranked r ON r.city = d.city AND r.service_date = d.service_date AND r.rk = 1
  JOIN snap e ON e.city = d.city AND e.seq = 1)
SELECT p.*, s.next_snapshot, isodow(p.service_date) < 6 AS is_weekday
FROM picked p JOIN snap s USING (city, snapshot)"""


def newest_snapshot(spark, sf_dir):
    return snapshots.newest(snapshots.catalogue(views.snapshot_files(spark, sf_dir), CITY), CITY)


NEWEST_SQL = f"WITH {FILES} SELECT city, max(snapshot) AS snapshot FROM snap GROUP BY city"


def unloaded_feeds(spark, sf_dir):
    """Feeds before 1996 were used upstream, those loaded now start in June 1995."""
    catalogue = snapshots.catalogue(views.snapshot_files(spark, sf_dir), CITY)
    recorded = snapshots.in_range(catalogue, "1995-01-01", "1995-12-31")
    loaded = snapshots.in_range(catalogue, "1995-06-01", "2030-01-01").select("snapshot").distinct()
    return snapshots.unloaded_feeds(recorded, loaded)


UNLOADED_SQL = f"""WITH {FILES}
SELECT DISTINCT snapshot FROM snap WHERE snap_date BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'
AND snapshot NOT IN (SELECT snapshot FROM snap WHERE snap_date BETWEEN DATE '1995-06-01' AND DATE '2030-01-01')"""


def shape_route_types(spark, sf_dir):
    """Route metadata per geometry: suppliers are routes, their nations the lines."""
    trips = views.supplier_trips(spark, sf_dir)
    bridge = views.table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") % 20).cast("string").alias("shape_key"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("shape_id"),
    )
    feeds = spark.createDataFrame([("f0", 1), ("f1", 2)], "snapshot string, seq int")
    out = serve.shape_routes(bridge, trips, views.supplier_routes(spark, sf_dir), feeds)
    return out.select(
        "shape_key",
        F.array_join("shape_ids", ",").alias("shape_ids"),
        F.array_join("route_ids", ",").alias("route_ids"),
        F.array_join("route_names", ",").alias("route_names"),
        "route_type",
    )


SHAPE_ROUTES_SQL = """
WITH r AS (
  SELECT s_suppkey % 2 AS seq, 'R' || s_suppkey AS route_id, 'N' || s_nationkey AS shape_id,
         CASE WHEN s_suppkey % 7 = 0 THEN 'R' || s_suppkey ELSE s_name END AS name,
         CASE WHEN s_nationkey % 6 = 1 THEN 99 WHEN s_nationkey % 6 = 2 THEN s_suppkey % 3
              ELSE s_nationkey % 4 END AS route_type
  FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)),
newest AS (
  SELECT r.* FROM r JOIN (SELECT shape_id, max(seq) AS seq FROM r GROUP BY shape_id) USING (shape_id, seq)),
typed AS (
  SELECT shape_id, CASE WHEN count(DISTINCT route_type) = 1 THEN max(route_type) END AS type
  FROM newest GROUP BY shape_id),
bridge AS (SELECT CAST(n_nationkey % 20 AS VARCHAR) AS shape_key, 'N' || n_nationkey AS shape_id FROM nation)
SELECT b.shape_key, string_agg(DISTINCT b.shape_id, ',' ORDER BY b.shape_id) AS shape_ids,
       coalesce(string_agg(DISTINCT n.route_id, ',' ORDER BY n.route_id), '') AS route_ids,
       coalesce(string_agg(DISTINCT n.name, ',' ORDER BY n.name), '') AS route_names,
       CAST(CASE WHEN count(DISTINCT t.type) = 1 THEN max(t.type) END AS INTEGER) AS route_type
FROM bridge b LEFT JOIN newest n USING (shape_id) LEFT JOIN typed t USING (shape_id) GROUP BY b.shape_key"""


QUERIES = {
    "schedule_signatures": (schedule_signatures, SIGNATURES_SQL),
    "day_exclusions": (day_exclusions, EXCLUSIONS_SQL),
    "schedule_periods": (schedule_periods, PERIODS_SQL),
    "period_summaries": (period_summaries, SUMMARY_SQL),
    "current_period": (current_period, CURRENT_SQL),
    "period_index": (period_index, PERIOD_INDEX_SQL),
    "schedule_churn": (schedule_churn, CHURN_SQL),
    "snapshot_catalogue": (snapshot_catalogue, CATALOGUE_SQL),
    "snapshot_as_of": (snapshot_as_of, AS_OF_SQL),
    "newest_snapshot": (newest_snapshot, NEWEST_SQL),
    "unloaded_feeds": (unloaded_feeds, UNLOADED_SQL),
    "shape_route_types": (shape_route_types, SHAPE_ROUTES_SQL),
}
