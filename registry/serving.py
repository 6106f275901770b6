"""Queries over serving tables and the time-of-day analysis, from line items as bins."""

from __future__ import annotations

from pyspark.sql import functions as F

import driver_views as views
from fleetgrain.functions.clock import SLOTS_PER_DAY, slot_label
from fleetgrain.functions.keys import bin_key, route_type_label, split_bin_key
from fleetgrain.operators import profile, serve
from fleetgrain.plans import export
from registry.common import stage, walk_lines, walk_shapes, walk_trips

MIN_SLOTS = 15
BINS = """
bins AS (
  SELECT l_returnflag AS period_key, CAST(l_suppkey % 25 AS VARCHAR) AS shape_key,
         l_linenumber AS segment_index,
         lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0') ||
           CASE WHEN l_partkey % 24 = 17 THEN ':15' ELSE ':00' END AS timeslot,
         round(median(CASE WHEN l_suppkey % 25 = 7 AND l_linenumber = 3 THEN 0
                           ELSE l_extendedprice / l_quantity / 301.7e0 END), 3) AS median_speed_ms,
         count(*) AS n_samples
  FROM lineitem GROUP BY ALL)
"""
SEGMENTS = f"""{BINS},
known AS (SELECT CAST(n_nationkey AS VARCHAR) AS shape_key FROM nation WHERE n_nationkey % 9 <> 4),
kept AS (SELECT period_key AS bundle, * EXCLUDE (period_key) FROM bins WHERE n_samples >= 2),
seg AS (
  SELECT *, row_number() OVER (PARTITION BY bundle ORDER BY shape_key, segment_index) - 1 AS segment_idx
  FROM (SELECT DISTINCT bundle, shape_key, segment_index FROM kept JOIN known USING (shape_key))),
slots AS (
  SELECT bundle, timeslot, segment_idx, CAST(round_even(median_speed_ms * 3.6e0, 0) AS INTEGER) AS speed_kmh,
         n_samples
  FROM kept JOIN seg USING (bundle, shape_key, segment_index)),
base AS (
  SELECT bundle, segment_idx, count(*) AS filled_slots,
         CASE WHEN count(*) >= 15 THEN CAST(round_even(median(speed_kmh), 0) AS INTEGER) END AS typical_kmh
  FROM slots GROUP BY ALL)
"""
TABLE = f"""{BINS},
seg AS (SELECT period_key, shape_key, segment_index, timeslot, median_speed_ms * 3.6e0 AS kmh
        FROM bins WHERE n_samples >= 2)
"""


def _bins(spark, sf_dir):
    return stage(spark, sf_dir, "item_bins", views.item_bins)


def _bundles(spark, sf_dir):
    return _bins(spark, sf_dir).withColumnRenamed("period_key", "bundle")


def sample_bins(spark, sf_dir):
    """Median per bin over every line item, not kept."""
    return views.item_bins(spark, sf_dir)


SAMPLE_BINS_SQL = f"WITH {BINS} SELECT * FROM bins"


def bundle_counts(spark, sf_dir):
    return serve.bundle_counts(_bundles(spark, sf_dir), views.nation_shapes(spark, sf_dir), min_samples=4)


COUNTS_SQL = f"""WITH {BINS},
known AS (SELECT CAST(n_nationkey AS VARCHAR) AS shape_key FROM nation WHERE n_nationkey % 9 <> 4),
b AS (SELECT *, n_samples >= 4 AS kept, shape_key IN (SELECT shape_key FROM known) AS known FROM bins)
SELECT period_key AS bundle, count(*) AS bins_before, count(CASE WHEN kept THEN 1 END) AS bins_after,
       count(DISTINCT (shape_key, segment_index)) AS segments_before,
       count(DISTINCT CASE WHEN kept THEN (shape_key, segment_index) END) AS segments_after,
       count(DISTINCT CASE WHEN kept AND NOT known THEN (shape_key, segment_index) END) AS segments_missing,
       count(DISTINCT shape_key) AS shapes_observed,
       count(DISTINCT CASE WHEN kept AND known THEN shape_key END) AS shapes_written,
       round(100.0e0 * count(CASE WHEN NOT kept THEN 1 END) / count(*), 2) AS bins_dropped_pct,
       round(100.0e0 * (count(DISTINCT (shape_key, segment_index))
         - count(DISTINCT CASE WHEN kept THEN (shape_key, segment_index) END))
         / count(DISTINCT (shape_key, segment_index)), 2) AS segments_dropped_pct
FROM b GROUP BY period_key"""


def _indexed(spark, sf_dir):
    kept = serve.retained_bins(_bundles(spark, sf_dir))
    segments = serve.retained_segments(kept, views.nation_shapes(spark, sf_dir))
    return kept, serve.index_segments(segments)


def segment_index_table(spark, sf_dir):
    return _indexed(spark, sf_dir)[1]


INDEX_SQL = f"WITH {SEGMENTS} SELECT * FROM seg"


def unknown_segments(spark, sf_dir):
    kept = serve.retained_bins(_bundles(spark, sf_dir))
    return serve.unknown_segments(kept, views.nation_shapes(spark, sf_dir))


UNKNOWN_SQL = f"""WITH {SEGMENTS}
SELECT DISTINCT bundle, shape_key, segment_index FROM kept WHERE shape_key NOT IN (SELECT shape_key FROM known)"""


def _slots(spark, sf_dir):
    return serve.slot_bins(*_indexed(spark, sf_dir))


def serving_slots(spark, sf_dir):
    return _slots(spark, sf_dir)


SLOTS_SQL = f"WITH {SEGMENTS} SELECT * FROM slots"


def segment_baseline(spark, sf_dir):
    return serve.segment_baseline(_slots(spark, sf_dir), MIN_SLOTS)


BASELINE_SQL = f"WITH {SEGMENTS} SELECT * FROM base"


def slowdown_flags(spark, sf_dir):
    slots = _slots(spark, sf_dir)
    return serve.flag_slowdowns(slots, serve.segment_baseline(slots, MIN_SLOTS))


FLAGS_SQL = f"""WITH {SEGMENTS}
SELECT slots.*, filled_slots, typical_kmh,
       coalesce(speed_kmh <= 0.7e0 * typical_kmh AND typical_kmh - speed_kmh >= 4, false) AS is_slow
FROM slots LEFT JOIN base USING (bundle, segment_idx)"""


def slot_documents(spark, sf_dir):
    docs = serve.slot_documents(_slots(spark, sf_dir))
    arrays = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in docs.columns[2:]]
    return docs.select("bundle", "timeslot", *arrays)


DOCS_SQL = f"""WITH {SEGMENTS}
SELECT bundle, timeslot, string_agg(segment_idx, ',' ORDER BY segment_idx) AS segment_idx,
       string_agg(speed_kmh, ',' ORDER BY segment_idx) AS speed_kmh,
       string_agg(n_samples, ',' ORDER BY segment_idx) AS n_samples
FROM slots GROUP BY ALL"""


def route_type_counts(spark, sf_dir):
    """Segments per route type of their shape; nations give the type, some give none."""
    typed = serve.with_route_type(_indexed(spark, sf_dir)[1], _nation_types(spark, sf_dir))
    return serve.route_types_present(typed)


def _nation_types(spark, sf_dir):
    key = F.col("n_nationkey")
    return views.table(spark, sf_dir, "nation").select(
        key.cast("string").alias("shape_key"), F.when(key % 5 != 3, key % 14).alias("route_type")
    )


TYPES_SQL = f"""WITH {SEGMENTS}, typed AS (
  SELECT seg.*, coalesce(CASE WHEN n_nationkey % 5 <> 3 THEN n_nationkey % 14 END, -1) AS route_type
  FROM seg JOIN nation ON CAST(n_nationkey AS VARCHAR) = shape_key)
SELECT bundle, route_type, count(*) AS segments,
       CASE route_type WHEN -1 THEN 'Unknown type' WHEN 0 THEN 'Tram' WHEN 1 THEN 'Metro' WHEN 2 THEN 'Rail'
         WHEN 3 THEN 'Bus' WHEN 4 THEN 'Ferry' WHEN 5 THEN 'Cable tram' WHEN 6 THEN 'Aerial lift'
         WHEN 7 THEN 'Funicular' WHEN 11 THEN 'Trolleybus' WHEN 12 THEN 'Monorail'
         ELSE 'Type ' || route_type END AS label
FROM typed GROUP BY bundle, route_type"""


def enabled_route_types(spark, sf_dir):
    """Slots of the segments whose route type is switched on: bus, tram and unknown."""
    typed = serve.with_route_type(_indexed(spark, sf_dir)[1], _nation_types(spark, sf_dir))
    on = serve.enabled_segments(typed, [0, 3, -1])
    out = _slots(spark, sf_dir).join(on.select("bundle", "segment_idx", "route_type"), ["bundle", "segment_idx"])
    return out.withColumn("label", route_type_label(F.col("route_type")))


ENABLED_SQL = f"""WITH {SEGMENTS}, typed AS (
  SELECT seg.*, coalesce(CASE WHEN n_nationkey % 5 <> 3 THEN n_nationkey % 14 END, -1) AS route_type
  FROM seg JOIN nation ON CAST(n_nationkey AS VARCHAR) = shape_key)
SELECT slots.*, route_type,
       CASE route_type WHEN -1 THEN 'Unknown type' WHEN 0 THEN 'Tram' ELSE 'Bus' END AS label
FROM slots JOIN typed USING (bundle, segment_idx) WHERE route_type IN (0, 3, -1)"""


def composite_bin_keys(spark, sf_dir):
    """Interchange keys of the bins, written and split again."""
    key = bin_key(F.col("shape_key"), F.col("segment_index"), F.col("timeslot"))
    keyed = _bins(spark, sf_dir).select("period_key", key.alias("bin"))
    return keyed.select("period_key", "bin", *split_bin_key(F.col("bin")))


KEYS_SQL = f"""WITH {BINS}
SELECT period_key, concat_ws('|', shape_key, segment_index, timeslot) AS bin, shape_key, segment_index, timeslot
FROM bins"""


def first_slot_shown(spark, sf_dir):
    """Slot a reader opens each segment with: the carried one, 08:00, else the first."""
    slots = F.sort_array(F.collect_set("timeslot"))
    per = serve.retained_bins(_bins(spark, sf_dir), 4).groupBy("period_key", "shape_key", "segment_index")
    listed = per.agg(slots.alias("slots"))
    carried = F.when(F.col("segment_index") % 2 == 0, F.lit("17:15"))
    at = serve.pick_slot(F.col("slots"), carried).cast("int")
    return listed.select(
        "period_key", "shape_key", "segment_index", F.get("slots", at).alias("timeslot"), at.alias("position")
    )


FIRST_SLOT_SQL = f"""WITH {BINS},
l AS (SELECT period_key, shape_key, segment_index, list(timeslot ORDER BY timeslot) AS slots
      FROM bins WHERE n_samples >= 4 GROUP BY ALL),
p AS (SELECT *, CASE WHEN segment_index % 2 = 0 AND list_contains(slots, '17:15')
                     THEN list_position(slots, '17:15')
                     WHEN list_contains(slots, '08:00') THEN list_position(slots, '08:00') ELSE 1 END AS spot FROM l)
SELECT period_key, shape_key, segment_index, slots[spot] AS timeslot, CAST(spot - 1 AS INTEGER) AS position FROM p"""


def _segments(spark, sf_dir):
    return profile.segment_table(_bins(spark, sf_dir))


def network_profile(spark, sf_dir):
    """Profile on the full spine of slots; slots nobody observed are null."""
    out = profile.network_profile(_segments(spark, sf_dir))
    periods = out.select("period_key").distinct()
    slots = periods.select("period_key", F.explode(F.sequence(F.lit(0), F.lit(SLOTS_PER_DAY - 1))).alias("i"))
    spine = slots.select("period_key", slot_label(F.col("i")).alias("timeslot"))
    return spine.join(out, ["period_key", "timeslot"], "left").withColumn("median_kmh", F.round("median_kmh", 4))


PROFILE_SQL = f"""WITH {TABLE},
spine AS (SELECT lpad(CAST(i // 4 AS VARCHAR), 2, '0') || ':' || lpad(CAST(i % 4 * 15 AS VARCHAR), 2, '0')
          AS timeslot FROM range(96) r(i)),
p AS (SELECT period_key, timeslot, round(median(kmh), 4) AS median_kmh, count(*) AS segments FROM seg GROUP BY ALL)
SELECT k.period_key, spine.timeslot, p.median_kmh, p.segments
FROM (SELECT DISTINCT period_key FROM seg) k CROSS JOIN spine LEFT JOIN p USING (period_key, timeslot)"""


def core_extremes(spark, sf_dir):
    out = profile.core_extremes(profile.network_profile(_segments(spark, sf_dir)))
    return _round(out, ["lowest_kmh", "highest_kmh", "range_kmh"])


def _round(df, names):
    for name in names:
        df = df.withColumn(name, F.round(name, 4))
    return df


CORE_SQL = f"""WITH {TABLE},
p AS (SELECT period_key, timeslot, median(kmh) AS kmh FROM seg
      WHERE timeslot BETWEEN '07:00' AND '19:00' GROUP BY ALL)
SELECT period_key, round(min(kmh), 4) AS lowest_kmh, arg_min(timeslot, (kmh, timeslot)) AS lowest_slot,
       round(max(kmh), 4) AS highest_kmh,
       arg_min(timeslot, (-kmh, timeslot)) AS highest_slot, round(max(kmh) - min(kmh), 4) AS range_kmh
FROM p GROUP BY period_key"""

_STATS = """
SELECT {keys}, count(CASE WHEN a <> 0 AND b <> 0 THEN 1 END) AS n, count(CASE WHEN a = 0 OR b = 0 THEN 1 END) AS zeroes,
       round(median(d), 4) AS median_diff, round(count(CASE WHEN d < 0 THEN 1 END) / nullif(count(d), 0), 6) AS share_a_slower,
       round(list_sort(list(d) FILTER (d IS NOT NULL))[count(d) // 4 + 1], 4) AS iqr_low,
       round(list_sort(list(d) FILTER (d IS NOT NULL))[3 * count(d) // 4 + 1], 4) AS iqr_high
FROM (SELECT *, CASE WHEN a <> 0 AND b <> 0 THEN a - b END AS d FROM pairs WHERE a IS NOT NULL AND b IS NOT NULL)
GROUP BY {keys}"""


def paired_comparisons(spark, sf_dir):
    out = profile.paired(_segments(spark, sf_dir))
    return _round(out, ["median_diff", "iqr_low", "iqr_high"]).withColumn(
        "share_a_slower", F.round("share_a_slower", 6)
    )


PAIRED_SQL = f"""WITH {TABLE},
v AS (
  SELECT period_key, shape_key, segment_index, max(kmh) FILTER (timeslot = '08:00') AS morning,
         max(kmh) FILTER (timeslot = '12:00') AS midday, max(kmh) FILTER (timeslot = '17:15') AS evening,
         median(kmh) FILTER (timeslot BETWEEN '00:00' AND '03:45') AS night,
         median(kmh) FILTER (timeslot BETWEEN '07:00' AND '18:45') AS daytime
  FROM seg GROUP BY ALL),
pairs AS (
  SELECT period_key, 'morning peak vs midday' AS label, morning AS a, midday AS b FROM v
  UNION ALL SELECT period_key, 'evening peak vs midday', evening, midday FROM v
  UNION ALL SELECT period_key, 'evening peak vs morning peak', evening, morning FROM v
  UNION ALL SELECT period_key, 'night vs day', night, daytime FROM v)
{_STATS.format(keys="period_key, label")}"""


def period_difference(spark, sf_dir):
    out = profile.against(_segments(spark, sf_dir), "R", "A")
    return _round(out, ["median_diff", "iqr_low", "iqr_high"]).withColumn(
        "share_a_slower", F.round("share_a_slower", 6)
    )


AGAINST_SQL = f"""WITH {TABLE},
cell AS (
  SELECT period_key, shape_key, segment_index, timeslot AS label, max(kmh) AS kmh FROM seg
  WHERE timeslot IN ('07:00', '08:00', '09:00', '10:00', '11:00', '12:00', '13:00', '14:00', '15:00',
                     '16:00', '17:00', '18:00', '19:00', '17:15') GROUP BY ALL
  UNION ALL
  SELECT period_key, shape_key, segment_index, '07:00-18:45', median(kmh) FROM seg
  WHERE timeslot BETWEEN '07:00' AND '18:45' GROUP BY ALL
  UNION ALL
  SELECT period_key, shape_key, segment_index, '00:00-03:45', median(kmh) FROM seg
  WHERE timeslot BETWEEN '00:00' AND '03:45' GROUP BY ALL),
pairs AS (
  SELECT x.label, x.kmh AS a, y.kmh AS b FROM cell x JOIN cell y USING (shape_key, segment_index, label)
  WHERE x.period_key = 'R' AND y.period_key = 'A')
{_STATS.format(keys="label")}"""


def common_segments(spark, sf_dir):
    return profile.common_segments(_segments(spark, sf_dir), "R", "A")


COMMON_SQL = f"""WITH {TABLE},
r AS (SELECT DISTINCT shape_key, segment_index FROM seg WHERE period_key = 'R'),
a AS (SELECT DISTINCT shape_key, segment_index FROM seg WHERE period_key = 'A')
SELECT (SELECT count(*) FROM r) AS later_segments, (SELECT count(*) FROM a) AS earlier_segments,
       (SELECT count(*) FROM (FROM r INTERSECT FROM a)) AS in_both"""


def slow_persistence(spark, sf_dir):
    return profile.persistence(_segments(spark, sf_dir), cuts=(20.0, 22.0, 25.0)).withColumn(
        "share", F.round("share", 6)
    )


PERSISTENCE_SQL = f"""WITH {TABLE},
v AS (SELECT period_key, shape_key, segment_index, max(kmh) FILTER (timeslot = '08:00') AS a,
             max(kmh) FILTER (timeslot = '12:00') AS b FROM seg GROUP BY ALL),
c AS (SELECT * FROM v, (VALUES (20.0e0), (22.0e0), (25.0e0)) t(cut_kmh) WHERE a IS NOT NULL AND b IS NOT NULL)
SELECT period_key, cut_kmh, count(CASE WHEN a <> 0 AND b <> 0 THEN 1 END) AS population, count(CASE WHEN a = 0 OR b = 0 THEN 1 END) AS zeroes,
       count(CASE WHEN a <> 0 AND b <> 0 AND a < cut_kmh THEN 1 END) AS slow_at_a,
       count(CASE WHEN a <> 0 AND b <> 0 AND a < cut_kmh AND b < cut_kmh THEN 1 END) AS still_slow,
       round(count(CASE WHEN a <> 0 AND b <> 0 AND a < cut_kmh AND b < cut_kmh THEN 1 END)
             / greatest(count(CASE WHEN a <> 0 AND b <> 0 AND a < cut_kmh THEN 1 END), 1), 6) AS share
FROM c GROUP BY ALL"""


def window_populations(spark, sf_dir):
    return profile.populations(_segments(spark, sf_dir))


POPULATIONS_SQL = f"""WITH {TABLE}
SELECT period_key,
       count(DISTINCT CASE WHEN timeslot BETWEEN '07:00' AND '18:45' THEN (shape_key, segment_index) END)
         AS day_segments,
       count(DISTINCT CASE WHEN timeslot BETWEEN '00:00' AND '03:45' THEN (shape_key, segment_index) END)
         AS night_segments
FROM seg GROUP BY period_key"""


def profile_edge_runs(spark, sf_dir):
    return profile.edge_runs(profile.network_profile(_segments(spark, sf_dir)), solid_min=148)


EDGES_SQL = f"""WITH {TABLE},
p AS (SELECT period_key, timeslot, count(*) >= 148 AS here FROM seg GROUP BY ALL),
e AS (SELECT period_key, timeslot, lead(timeslot) OVER o AS to_slot, here AND lead(here) OVER o AS solid
      FROM p WINDOW o AS (PARTITION BY period_key ORDER BY timeslot)),
x AS (SELECT *, coalesce(lag(solid) OVER o <> solid, false) AS changed FROM e WHERE to_slot IS NOT NULL
      WINDOW o AS (PARTITION BY period_key ORDER BY timeslot)),
r AS (SELECT *, CAST(sum(CAST(changed AS INTEGER)) OVER (PARTITION BY period_key ORDER BY timeslot) AS BIGINT) AS run_no FROM x)
SELECT period_key, run_no, bool_or(solid) AS solid, min(timeslot) AS from_slot, max(to_slot) AS to_slot,
       count(*) AS edges
FROM r GROUP BY period_key, run_no"""


def _customer_segments(spark, sf_dir):
    """Every 20 km segment of every customer line, and one past its end."""
    keyed = walk_shapes(spark, sf_dir)
    last = (F.element_at("cum_dist", -1) / 20000).cast("int")
    return keyed.select("shape_key", F.explode(F.sequence(F.lit(0), last + 1)).alias("segment_index"))


def segment_paths(spark, sf_dir):
    """Simplified path of each segment; the lines are straight, so two points each."""
    paths = serve.draw_paths(_customer_segments(spark, sf_dir), walk_shapes(spark, sf_dir), 20000.0)
    ends = [F.element_at("points", 1), F.element_at("points", -1)]
    return paths.select(
        "shape_key",
        "segment_index",
        F.size("points").alias("n_points"),
        F.round(ends[0]["lat"], 4).alias("from_lat"),
        F.round(ends[1]["lat"], 4).alias("to_lat"),
        F.round(ends[0]["lon"], 4).alias("lon"),
    )


PATHS_SQL = """WITH line AS (
  SELECT c_custkey, i, 42.5e0 + degrees(i * (5000.0e0 + (c_custkey % 40) * 100) / 6371000.0e0) AS lat,
         20.0e0 + c_custkey * 0.0005e0 AS lon
  FROM customer, range(60) r(i) WHERE c_custkey % 13 <> 5),
geo AS (
  SELECT c_custkey, sha256(string_agg(printf('%.6f,%.6f', lat, lon), ';' ORDER BY i))[1:16] AS shape_key,
         59 * (5000.0e0 + (c_custkey % 40) * 100) AS len
  FROM line GROUP BY c_custkey),
want AS (
  SELECT *, CAST(unnest(range(0, CAST(floor((len + 0.001e0) / 20000) AS INTEGER) + 2)) AS INTEGER) AS segment_index FROM geo)
SELECT shape_key, segment_index, 2 AS n_points,
       round(round(42.5e0 + degrees(least(segment_index * 20000.0e0, len) / 6371000.0e0), 5), 4) AS from_lat,
       round(round(42.5e0 + degrees(least((segment_index + 1) * 20000.0e0, len) / 6371000.0e0), 5), 4) AS to_lat,
       round(round(20.0e0 + c_custkey * 0.0005e0, 5), 4) AS lon
FROM want"""


def _placed_paths(spark, sf_dir):
    """Numbered and placed paths of every customer segment, a bundle per line family.

    Paths are stored before they are numbered, as numbering reads them several times.
    """
    drawn = stage(
        spark, sf_dir, "drawn_paths", lambda s, d: serve.draw_paths(_customer_segments(s, d), walk_shapes(s, d), 20000.0)
    )
    return serve.point_offsets(serve.index_segments(drawn.withColumn("bundle", F.substring("shape_key", 1, 1))))


def geometry_offsets(spark, sf_dir):
    """Flat point offsets of drawn segments, one bundle per line family."""
    return _placed_paths(spark, sf_dir).select(
        "bundle", "segment_idx", "shape_key", "segment_index", F.size("points").alias("n_points"), "point_offset"
    )


OFFSETS_SQL = PATHS_SQL.split("SELECT shape_key, segment_index, 2")[0] + """
, d AS (SELECT DISTINCT shape_key[1:1] AS bundle, shape_key, segment_index FROM want)
SELECT bundle, row_number() OVER o - 1 AS segment_idx, shape_key, segment_index, 2 AS n_points,
       2 * (row_number() OVER o - 1) AS point_offset
FROM d WINDOW o AS (PARTITION BY bundle ORDER BY shape_key, segment_index)"""


def _customer_geometry(spark, sf_dir):
    """Placed segment paths and the shape table of the customer lines, a bundle per line family."""
    lines, trips = walk_lines(spark, sf_dir), walk_trips(spark, sf_dir)
    named = trips.select("snapshot", "route_id").distinct()
    type_no = F.length("route_id") % 4
    routes = named.select(
        "*",
        F.when(type_no == 2, "").otherwise(F.substring("route_id", 1, 3)).alias("route_short_name"),
        F.when(type_no != 1, type_no).alias("route_type"),
    )
    order = spark.createDataFrame([("s1", 1), ("s2", 2)], "snapshot string, seq int")
    known = serve.shape_routes(lines.select("shape_key", "shape_id"), trips, routes, order)
    # every line has segments
    drawn = walk_shapes(spark, sf_dir).select(F.substring("shape_key", 1, 1).alias("bundle"), "shape_key")
    return _placed_paths(spark, sf_dir), serve.shape_table(drawn, known)


def geometry_documents(spark, sf_dir):
    """The published document of each bundle: shape table, shape_idx of each segment, flat points and offsets."""
    placed, table = _customer_geometry(spark, sf_dir)
    # made flat entry by entry, as the document's lists are as long as a bundle
    lists = ["shape_ids", "route_ids", "route_names"]
    flat = {name: F.array_join(name, ",") for name in lists}
    table = table.withColumns({**flat, "route_type": F.coalesce("route_type", F.lit(-1))})
    point = lambda p: F.struct(*[F.round(p[name], 4).alias(name) for name in ("lat", "lon")])
    placed = placed.withColumn("points", F.transform("points", point))
    return serve.geometry_document(placed, table, segment_length_m=20000.0).drop("typical_kmh")


GEOMETRY_SQL = PATHS_SQL.split("SELECT shape_key, segment_index, 2")[0] + """,
fact AS (
  SELECT shape_key, 'S' || g.c_custkey AS shape_id, length(c_mktsegment) % 4 AS kind,
         CASE WHEN c.c_custkey % 17 <> 4 THEN c_mktsegment END AS route_id
  FROM geo g JOIN customer c USING (c_custkey)),
shape AS (
  SELECT shape_key[1:1] AS bundle, shape_key, row_number() OVER (PARTITION BY shape_key[1:1] ORDER BY shape_key) - 1 AS shape_idx,
         string_agg(shape_id, ',' ORDER BY shape_id) AS ids, coalesce(any_value(route_id), '') AS routes,
         coalesce(any_value(CASE WHEN route_id IS NULL THEN NULL WHEN kind = 2 THEN route_id ELSE route_id[1:3] END), '') AS names,
         coalesce(any_value(CASE WHEN route_id IS NOT NULL AND kind <> 1 THEN kind END), -1) AS kind
  FROM fact GROUP BY shape_key),
d AS (SELECT DISTINCT shape_key, segment_index, len, c_custkey FROM want),
seg AS (
  SELECT bundle, shape_idx, d.*, row_number() OVER (PARTITION BY bundle ORDER BY shape_key, segment_index) - 1 AS segment_idx
  FROM d JOIN shape USING (shape_key)),
ends AS (
  SELECT *, round(round(42.5e0 + degrees(least((segment_index + side) * 20000.0e0, len) / 6371000.0e0), 5), 4) AS lat,
         round(round(20.0e0 + c_custkey * 0.0005e0, 5), 4) AS lon
  FROM seg, range(2) r(side)),
points AS (SELECT bundle, list(lat ORDER BY segment_idx, side) AS lat, list(lon ORDER BY segment_idx, side) AS lon FROM ends GROUP BY bundle),
tables AS (
  SELECT bundle, list(shape_key ORDER BY shape_idx) AS shape_keys, list(ids ORDER BY shape_idx) AS shape_ids,
         list(routes ORDER BY shape_idx) AS shape_route_ids, list(names ORDER BY shape_idx) AS shape_route_names,
         list(CAST(kind AS INTEGER) ORDER BY shape_idx) AS shape_route_type
  FROM shape GROUP BY bundle)
SELECT bundle, 20000.0e0 AS segment_length_m, shape_keys, shape_ids, shape_route_ids, shape_route_names, shape_route_type,
       list(shape_idx ORDER BY segment_idx) AS shape_idx, list(segment_index ORDER BY segment_idx) AS segment_index,
       range(0, 2 * count(*) + 1, 2) AS point_offset, any_value(lat) AS lat, any_value(lon) AS lon
FROM seg JOIN points USING (bundle) JOIN tables USING (bundle)
GROUP BY bundle, shape_keys, shape_ids, shape_route_ids, shape_route_names, shape_route_type"""


def bundle_records(spark, sf_dir):
    """What the bundles of line items state about themselves."""
    bundles, shapes = _bundles(spark, sf_dir), views.nation_shapes(spark, sf_dir)
    kept, indexed = _indexed(spark, sf_dir)
    slots = serve.slot_bins(kept, indexed)
    number = F.col("shape_key").cast("int")
    known = shapes.select(
        "shape_key",
        F.array("shape_key").alias("shape_ids"),
        F.transform(F.sequence(F.lit(0), number % 3), lambda i: i.cast("string")).alias("route_ids"),
        F.array().cast("array<string>").alias("route_names"),
        F.lit(3).alias("route_type"),
    )
    items = views.table(spark, sf_dir, "lineitem")
    days = items.select(
        F.col("l_returnflag").alias("bundle"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("service_date")
    ).distinct()
    about = days.filter("bundle <> 'N'").groupBy(F.col("bundle").alias("period_key")).agg(
        F.min("service_date").alias("first_date"), F.max("service_date").alias("last_date")
    )
    about = about.select(
        "*", F.col("first_date").alias("reference_date"), F.lit(7).alias("route_count"), F.lit(9).cast("bigint").alias("trip_count")
    )
    records = export.bundle_records(bundles, days, shapes, slots, serve.shape_table(indexed, known), about=about)
    return records.select(
        "bundle",
        "mode",
        "format_version",
        "bins_dropped",
        "segments_after",
        "shapes_written",
        "multi_route_shapes",
        "timeslot_count",
        F.array_join("timeslots", ",").alias("timeslots"),
        F.size("days_in_median").alias("days"),
        F.array_join(F.transform("days_in_median", lambda d: d.cast("string")), ",").alias("days_in_median"),
        F.col("schedule_period.first_date").alias("first_date"),
        F.col("schedule_period.last_date").alias("last_date"),
        "min_samples",
        "max_speed_kmh",
    )


RECORDS_SQL = f"""WITH {BINS},
known AS (SELECT CAST(n_nationkey AS VARCHAR) AS shape_key, n_nationkey % 3 > 0 AS several FROM nation WHERE n_nationkey % 9 <> 4),
b AS (SELECT bins.*, n_samples >= 2 AS kept, known.shape_key IS NOT NULL AS known, coalesce(several, false) AS several
      FROM bins LEFT JOIN known USING (shape_key)),
d AS (SELECT DISTINCT l_returnflag AS bundle, CAST(date_trunc('month', l_shipdate) AS DATE) AS day FROM lineitem),
days AS (SELECT bundle, CAST(count(*) AS INTEGER) AS days, string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) AS days_in_median,
                min(day) AS first_date, max(day) AS last_date FROM d GROUP BY bundle)
SELECT period_key AS bundle, 'typical_weekday' AS mode, 2 AS format_version, count(CASE WHEN NOT kept THEN 1 END) AS bins_dropped,
       count(DISTINCT CASE WHEN kept THEN (shape_key, segment_index) END) AS segments_after,
       count(DISTINCT CASE WHEN kept AND known THEN shape_key END) AS shapes_written,
       count(DISTINCT CASE WHEN kept AND several THEN shape_key END) AS multi_route_shapes,
       CAST(count(DISTINCT CASE WHEN kept AND known THEN timeslot END) AS INTEGER) AS timeslot_count,
       string_agg(DISTINCT timeslot, ',' ORDER BY timeslot) FILTER (kept AND known) AS timeslots,
       any_value(days) AS days, any_value(days_in_median) AS days_in_median,
       any_value(CASE WHEN period_key <> 'N' THEN first_date END) AS first_date,
       any_value(CASE WHEN period_key <> 'N' THEN last_date END) AS last_date,
       2 AS min_samples, 100.0e0 AS max_speed_kmh
FROM b JOIN days ON days.bundle = period_key GROUP BY period_key"""


def window_medians(spark, sf_dir):
    windows = {"day_kmh": ("07:00", "18:45"), "night_kmh": ("00:00", "03:45")}
    return _round(profile.window_medians(_segments(spark, sf_dir), windows), list(windows))


WINDOWS_SQL = f"""WITH {TABLE}
SELECT period_key, shape_key, segment_index,
       round(median(kmh) FILTER (timeslot BETWEEN '07:00' AND '18:45'), 4) AS day_kmh,
       round(median(kmh) FILTER (timeslot BETWEEN '00:00' AND '03:45'), 4) AS night_kmh
FROM seg GROUP BY ALL"""


def _period_days(spark, sf_dir):
    """Ship dates as the days behind each return flag's bundle, and their quality records."""
    items = views.table(spark, sf_dir, "lineitem")
    date = F.to_date("l_shipdate")
    days = items.select(F.col("l_returnflag").alias("bundle"), date.alias("service_date")).distinct()
    tax = F.sum((F.col("l_tax") * 100).cast("int"))
    manifests = items.groupBy(date.alias("service_date")).agg(
        (F.count(F.lit(1)) % 17 == 0).alias("day_in_progress"),
        (F.lit(95.0) + (tax % 50) / 10).alias("coverage_pct"),
    )
    return days, manifests


PERIOD_DAYS = """
day AS (SELECT DISTINCT l_returnflag AS bundle, CAST(l_shipdate AS DATE) AS service_date FROM lineitem),
man AS (SELECT CAST(l_shipdate AS DATE) AS service_date, count(*) % 17 = 0 AS day_in_progress,
               95.0e0 + (sum(CAST(trunc(l_tax * 100) AS BIGINT)) % 50) / 10e0 AS coverage_pct
        FROM lineitem GROUP BY 1),
note AS (SELECT bundle, service_date,
                CASE WHEN day_in_progress THEN 'day was still in progress when its own manifest was generated, not a closed calendar day'
                     WHEN coverage_pct < 99 THEN 'only ' || coverage_pct || '% coverage of the calendar day' END AS note
         FROM day JOIN man USING (service_date))
"""


def incomplete_day_notes(spark, sf_dir):
    return serve.incomplete_days(*_period_days(spark, sf_dir))


NOTES_SQL = f"WITH {PERIOD_DAYS} SELECT * FROM note WHERE note IS NOT NULL"


def drawn_incomplete_days(spark, sf_dir):
    """Incomplete days that really stand behind a bundle: its Mondays are the median days."""
    days, manifests = _period_days(spark, sf_dir)
    notes = serve.incomplete_days(days, manifests)
    named = notes.groupBy("bundle").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("service_date").cast("string"), "note"))).alias(
            "incomplete_days"
        )
    )
    mondays = days.filter(F.weekday("service_date") == 0).groupBy("bundle").agg(
        F.collect_list(F.col("service_date").cast("string")).alias("days_in_median")
    )
    out = serve.drawn_incomplete(named.join(mondays, "bundle"))
    return out.select("bundle", F.explode("drawn_incomplete").alias("service_date"))


DRAWN_SQL = f"""WITH {PERIOD_DAYS}
SELECT bundle, CAST(service_date AS VARCHAR) AS service_date FROM note
WHERE note IS NOT NULL AND isodow(service_date) = 1"""


def drawable_slots(spark, sf_dir):
    """Slots joined to their polylines, here the first and last point of 20 km stretches."""
    segments = _customer_segments(spark, sf_dir).withColumn("bundle", F.substring("shape_key", 1, 1))
    shapes = walk_shapes(spark, sf_dir)
    indexed = serve.index_segments(segments)
    paths = indexed.join(serve.draw_paths(segments.drop("bundle"), shapes, 20000.0), ["shape_key", "segment_index"])
    bins = segments.select(
        "bundle",
        "shape_key",
        "segment_index",
        F.lit("08:00").alias("timeslot"),
        (F.col("segment_index") + F.lit(0.5)).alias("median_speed_ms"),
        F.lit(2).alias("n_samples"),
    )
    out = serve.drawable_slots(serve.slot_bins(bins, indexed), paths)
    return out.select(
        "bundle", "segment_idx", "timeslot", "speed_kmh", F.round(F.col("points")[0]["lat"], 4).alias("from_lat")
    )


DRAWABLE_SQL = PATHS_SQL.split("SELECT shape_key, segment_index, 2")[0] + """
, d AS (SELECT DISTINCT shape_key, segment_index FROM want)
SELECT shape_key[1:1] AS bundle,
       row_number() OVER (PARTITION BY shape_key[1:1] ORDER BY shape_key, segment_index) - 1 AS segment_idx, '08:00' AS timeslot,
       CAST(round_even((segment_index + 0.5e0) * 3.6e0, 0) AS INTEGER) AS speed_kmh,
       (SELECT any_value(round(round(42.5e0 + degrees(least(w.segment_index * 20000.0e0, w.len) / 6371000.0e0), 5), 4))
        FROM want w WHERE w.shape_key = d.shape_key AND w.segment_index = d.segment_index) AS from_lat
FROM d"""


QUERIES = {
    "window_medians": (window_medians, WINDOWS_SQL),
    "incomplete_day_notes": (incomplete_day_notes, NOTES_SQL),
    "drawn_incomplete_days": (drawn_incomplete_days, DRAWN_SQL),
    "drawable_slots": (drawable_slots, DRAWABLE_SQL),
    "sample_bins": (sample_bins, SAMPLE_BINS_SQL),
    "bundle_counts": (bundle_counts, COUNTS_SQL),
    "segment_index_table": (segment_index_table, INDEX_SQL),
    "unknown_segments": (unknown_segments, UNKNOWN_SQL),
    "serving_slots": (serving_slots, SLOTS_SQL),
    "segment_baseline": (segment_baseline, BASELINE_SQL),
    "slowdown_flags": (slowdown_flags, FLAGS_SQL),
    "slot_documents": (slot_documents, DOCS_SQL),
    "route_type_counts": (route_type_counts, TYPES_SQL),
    "enabled_route_types": (enabled_route_types, ENABLED_SQL),
    "composite_bin_keys": (composite_bin_keys, KEYS_SQL),
    "first_slot_shown": (first_slot_shown, FIRST_SLOT_SQL),
    "network_profile": (network_profile, PROFILE_SQL),
    "core_extremes": (core_extremes, CORE_SQL),
    "paired_comparisons": (paired_comparisons, PAIRED_SQL),
    "period_difference": (period_difference, AGAINST_SQL),
    "common_segments": (common_segments, COMMON_SQL),
    "slow_persistence": (slow_persistence, PERSISTENCE_SQL),
    "window_populations": (window_populations, POPULATIONS_SQL),
    "profile_edge_runs": (profile_edge_runs, EDGES_SQL),
    "segment_paths": (segment_paths, PATHS_SQL),
    "geometry_offsets": (geometry_offsets, OFFSETS_SQL),
    "geometry_documents": (geometry_documents, GEOMETRY_SQL),
    "bundle_records": (bundle_records, RECORDS_SQL),
}
