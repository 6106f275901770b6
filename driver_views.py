"""The driver's tables seen as transit tables, by plain arithmetic.

Only the registered queries use this; the engine does not. Their SQL forms
state the same arithmetic.
"""

from __future__ import annotations

import csv
import io
import zipfile
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrain.functions.clock import hour_of_name, local_date, slot_label
from fleetgrain.operators.ranks import exact_median
from fleetgrain.operators.shapes import keyed_points
from fleetgrain.params import EARTH_RADIUS_M, WalkParams
from fleetgrain.session import cut_lineage

TZ = "Europe/Athens"

# Events are hours apart and hops kilometres long, so every limit is scaled.
WALK = WalkParams(
    poll_interval_sec=5000.0,
    max_gap_sec=20000.0,
    max_speed_kmh=10.0,
    backward_tolerance_m=5000.0,
    search_margin_m=30000.0,
    segment_length_m=20000.0,
    timezone=TZ,
)
VALIDATION_KMH = 100.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_seconds(events: DataFrame) -> DataFrame:
    """Events with a month squeezed into about a week, on five-minute marks."""
    return events.withColumn(
        "snapshot_ts", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 1200) * 300 + 1278000000
    ).withColumn("service_date", F.to_date(F.timestamp_seconds("snapshot_ts")))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_seconds(table(spark, sf_dir, "events"))
    dist = (F.col("snapshot_ts") % 86400) * 1.0037117283 + (F.col("event_id") % 13) * 1200.1173911
    user = F.col("user_id").cast("string")
    return events.select(
        "service_date",
        "snapshot_ts",
        F.when(F.col("event_id") % 97 != 0, user).alias("vehicle_id"),
        F.when(F.col("event_id") % 89 != 0, user).otherwise("").alias("trip_id"),
        (F.lit(42.5) + F.degrees(dist / EARTH_RADIUS_M)).alias("lat"),
        (F.lit(20.0002) + F.col("user_id") * 0.0005).alias("lon"),
        F.col("value").alias("speed_ms"),
        F.col("event_id").alias("seq"),
    )


def torn_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions, some without latitude, some with a latitude or longitude that is no number."""
    seq, nan = F.col("seq"), F.lit(float("nan"))
    lat = F.when(seq % 101 == 0, F.lit(None)).when(seq % 103 == 0, nan).otherwise(F.col("lat"))
    lon = F.when(seq % 107 == 0, F.lit(float("inf"))).otherwise(F.col("lon"))
    return positions(spark, sf_dir).withColumns({"lat": lat, "lon": lon})


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that have a line, dealt by its id: a small file is one task, and points by line needn't move again."""
    key = F.col("c_custkey")
    line = table(spark, sf_dir, "customer").filter(key % 13 != 5)
    return line.select(F.concat(F.lit("S"), key.cast("string")).alias("shape_id"), key).repartition("shape_id")


def shape_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A straight line of 60 points per customer; some customers have none."""
    key = F.col("c_custkey")
    spacing = F.lit(5000.0) + (key % 40) * 100
    return _lines(spark, sf_dir).select(
        F.lit("s1").alias("snapshot"),
        "shape_id",
        F.explode(F.sequence(F.lit(0), F.lit(59))).alias("shape_pt_sequence"),
        key,
        spacing.alias("spacing"),
    ).select(
        "snapshot",
        "shape_id",
        "shape_pt_sequence",
        (F.lit(42.5) + F.degrees(F.col("shape_pt_sequence") * F.col("spacing") / EARTH_RADIUS_M)).alias(
            "shape_pt_lat"
        ),
        (F.lit(20.0) + F.col("c_custkey") * 0.0005).alias("shape_pt_lon"),
    )


# Lines of 150 points that go north for half their length and come back beside
# themselves, with a bend at every second point; fixes lie anywhere between the
# two halves, so only the search window tells which half a vehicle is on.
BENT = replace(WALK, search_margin_m=4000.0)
BENT_TURN_M = 42000.0


def bent_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, i = F.col("c_custkey"), F.col("shape_pt_sequence")
    steps = F.when(i < 75, i).otherwise(149 - i)
    north = steps * (F.lit(BENT_TURN_M / 74) + (key % 40) * 5)
    east = key * 0.0005 + F.when(i < 75, 0.0).otherwise(0.0101) + (i % 2) * 0.0007
    return _lines(spark, sf_dir).select(
        F.lit("s1").alias("snapshot"),
        "shape_id",
        F.explode(F.sequence(F.lit(0), F.lit(149))).alias("shape_pt_sequence"),
        key,
    ).select(
        "snapshot",
        "shape_id",
        "shape_pt_sequence",
        (F.lit(42.5) + F.degrees(north / EARTH_RADIUS_M)).alias("shape_pt_lat"),
        (F.lit(20.0) + east).alias("shape_pt_lon"),
    )


def bent_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    travelled = (F.col("snapshot_ts") % 86400) * 1.0037117283 + (seq % 13) * 1200.1173911
    north = F.when(travelled < BENT_TURN_M, travelled).otherwise(2 * BENT_TURN_M - travelled)
    lon = F.lit(20.0) + F.col("trip_id").try_cast("double") * 0.0005 + (seq % 7) * 0.0020173
    return positions(spark, sf_dir).withColumns(
        {"lat": F.lit(42.5) + F.degrees(north / EARTH_RADIUS_M), "lon": lon}
    )


def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_points(shape_points(spark, sf_dir), ["snapshot", "shape_id"])


def bent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_points(bent_points(spark, sf_dir), ["snapshot", "shape_id"])


def trips(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Snapshot s1 lacks some trips, s2 has most of those, a few are in neither."""
    keyed = lines.select("shape_id", "shape_key")
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        key.cast("string").alias("trip_id"),
        F.col("c_mktsegment").alias("route_id"),
        F.concat(F.lit("S"), key.cast("string")).alias("shape_id"),
        F.when(key % 17 == 4, F.array().cast("array<string>"))
        .when(key % 10 == 3, F.array(F.lit("s2")))
        .otherwise(F.array(F.lit("s1"), F.lit("s2")))
        .alias("snapshots"),
    )
    return (
        rows.join(keyed, "shape_id", "left")
        .withColumn("shape_key", F.coalesce("shape_key", F.lit("no-geometry")))
        .select(F.explode("snapshots").alias("snapshot"), "trip_id", "route_id", "shape_id", "shape_key")
    )


def walk_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan of the event days: Monday to Friday in one period per week."""
    days = event_seconds(table(spark, sf_dir, "events")).select("service_date").distinct()
    return days.select(
        "service_date",
        F.lit("s1").alias("snapshot"),
        F.lit("s2").alias("next_snapshot"),
        F.when(
            F.weekday("service_date") < 5,
            F.date_format(F.date_trunc("week", "service_date"), "yyyy-MM-dd"),
        ).alias("period_key"),
    )


# Orders as a timetable: three networks (order status), one "day" per month,
# a route per priority, a trip per order.


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Services run on the first of their month; a few are listed as removals."""
    trips = order_trips(spark, sf_dir)
    removed = F.col("service_id").endswith("-09-2")
    return trips.select(
        "snapshot",
        "service_id",
        F.date_format("service_date", "yyyyMMdd").alias("date"),
        F.when(removed, "2").otherwise("1").alias("exception_type"),
    ).distinct()


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    return orders.select(
        F.col("o_orderstatus").alias("snapshot"),
        F.concat(
            F.date_format(month, "yyyy-MM-"), (F.col("o_orderkey") % 3).cast("string")
        ).alias("service_id"),
        F.col("o_orderpriority").alias("route_id"),
        F.col("o_orderkey").alias("trip_id"),
        month.alias("service_date"),
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (network, month), and for each network a last month the calendar lacks."""
    months = order_trips(spark, sf_dir).select(F.col("snapshot").alias("city"), "service_date").distinct()
    last = months.groupBy("city").agg(F.add_months(F.max("service_date"), 1).alias("service_date"))
    return months.unionByName(last)


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of feed captures: two of an order date in some cases, and foreign names."""
    orders = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    clock = F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0")
    name = (
        F.when(F.col("o_orderkey") % 10 < 2, F.concat(F.lit("gtfs_"), day, F.lit(".zip")))
        .when(F.col("o_orderkey") % 10 < 3, F.concat(F.lit("gtfs_"), day, F.lit("T"), clock, F.lit("00.zip")))
        .otherwise(F.concat(F.lit("gtfs_"), day, F.lit(".zip.part")))
    )
    return orders.select(F.col("o_orderpriority").alias("city"), name.alias("name"))


# Line items as speed bins.


def item_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    hour = F.col("l_partkey") % 24
    slot = hour * 4 + F.when(hour == 17, 1).otherwise(0)
    shape = F.col("l_suppkey") % 25
    still = (shape == 7) & (F.col("l_linenumber") == 3)
    speed = F.when(still, 0.0).otherwise(F.col("l_extendedprice") / F.col("l_quantity") / 301.7)
    return items.select(
        F.col("l_returnflag").alias("period_key"),
        shape.cast("string").alias("shape_key"),
        F.col("l_linenumber").alias("segment_index"),
        slot_label(slot).alias("timeslot"),
        speed.alias("speed_raw"),
    )


def item_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["period_key", "shape_key", "segment_index", "timeslot"]
    out = exact_median(item_samples(spark, sf_dir), keys, "speed_raw", "median")
    return out.select(*keys, F.round("median", 3).alias("median_speed_ms"), F.col("n").alias("n_samples"))


def nation_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometry keys known to the serving step; three nations have none."""
    nations = table(spark, sf_dir, "nation").filter("n_nationkey % 9 <> 4")
    return nations.select(F.col("n_nationkey").cast("string").alias("shape_key"))


def supplier_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes from suppliers, two snapshots by key parity."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("f"), (F.col("s_suppkey") % 2).cast("string")).alias("snapshot"),
        F.concat(F.lit("R"), F.col("s_suppkey").cast("string")).alias("route_id"),
        F.when(F.col("s_suppkey") % 7 == 0, "").otherwise(F.col("s_name")).alias("route_short_name"),
        F.when(F.col("s_nationkey") % 6 == 1, 99)
        .when(F.col("s_nationkey") % 6 == 2, (F.col("s_suppkey") % 3).cast("int"))
        .otherwise(F.col("s_nationkey") % 4)
        .alias("route_type"),
    )


def supplier_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trip per line item: its supplier is the route, the supplier's nation the shape."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey")
    return items.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("f"), (F.col("s_suppkey") % 2).cast("string")).alias("snapshot"),
        F.concat(F.lit("R"), F.col("s_suppkey").cast("string")).alias("route_id"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("shape_id"),
    )


# Events as polls: one poll per event, on squeezed seconds.

NOW = 1704664790  # after the last event, before its local midnight
POLL_INTERVAL = 45


def poll_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    second = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 4) + 1278000000
    rows = events.withColumn("snapshot_ts", second)
    return rows.withColumn("service_date", local_date(F.col("snapshot_ts"), TZ))


def poll_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poll_seconds(spark, sf_dir).select("service_date", "snapshot_ts")


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some days have no heartbeat, some only from six hours on."""
    rows = poll_seconds(spark, sf_dir)
    day = F.dayofmonth("service_date")
    late = (day % 3 == 0) & (F.pmod(F.col("snapshot_ts") + 7200, F.lit(86400)) < 21600)
    return rows.filter((day % 4 != 1) & ~late).select(
        "service_date",
        "snapshot_ts",
        (F.col("event_type") != "error").alias("fetch_ok"),
        F.pmod(F.floor("value"), F.lit(3)).alias("vehicle_count"),
        (F.col("event_id") % 9 + 2).alias("entities_total"),
        (F.col("event_id") % 9 + 1).alias("vehicles_with_position"),
        (F.col("event_id") % 2).alias("dropped_out_of_bbox"),
    )


def decoded_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded poll responses: the events of one five-minute mark are its entities."""
    events = event_seconds(table(spark, sf_dir, "events"))
    user = F.col("user_id")
    position = F.struct(
        (F.lit(42.0) + user % 150 * 0.0101234567).alias("latitude"),
        (F.lit(23.0) + F.col("event_id") % 100 * 0.0101234567).alias("longitude"),
        F.lit(None).cast("double").alias("bearing"),
        (F.col("value") / 7).alias("speed"),
    )
    trip = F.struct(
        user.cast("string").alias("trip_id"),
        F.col("event_type").alias("route_id"),
        F.lit("SCHEDULED").alias("schedule_relationship"),
    )
    nothing = F.lit(None)
    vehicle = F.struct(
        F.struct(user.cast("string").alias("id")).alias("vehicle"),
        F.when(F.col("event_id") % 5 != 0, trip).alias("trip"),
        F.when(F.col("event_id") % 7 != 0, position).alias("position"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        nothing.cast("string").alias("stop_id"),
        F.lit("IN_TRANSIT_TO").alias("current_status"),
        nothing.cast("string").alias("occupancy_status"),
        nothing.cast("string").alias("congestion_level"),
    )
    entity = F.struct(F.when(F.col("event_id") % 11 != 0, vehicle).alias("vehicle"))
    return events.groupBy(F.col("snapshot_ts").alias("poll_ts")).agg(
        F.lit(True).alias("fetch_ok"), F.collect_list(entity).alias("entity")
    )


BOX = (42.1, 43.2, 23.05, 23.8)


def box() -> F.Column:
    names = ("lat_min", "lat_max", "lon_min", "lon_max")
    return F.struct(*[F.lit(v).alias(n) for v, n in zip(BOX, names)])


# Documents as archived day files and their manifests.


def doc_date(doc_id="doc_id"):
    return F.date_add(F.lit("2020-01-01").cast("date"), F.col(doc_id).cast("int"))


def doc_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    key = F.col("doc_id")
    return docs.join(labels, "doc_id", "left").select(
        doc_date().alias("service_date"),
        F.concat(F.lit("d"), key.cast("string")).alias("data_file"),
        F.sha2("text", 256).alias("data_sha256"),
        F.when(key % 3 == 0, F.concat(F.lit("p"), key.cast("string"))).alias("polls_file"),
        F.when(key % 3 == 0, F.sha2("source", 256)).alias("polls_sha256"),
        (key % 50 == 49).alias("day_in_progress"),
        F.when(key % 20 == 7, 1).when(key % 20 == 8, F.lit(None).cast("int")).otherwise(2).alias("schema_version"),
        F.when(F.col("toxic") == 1, F.col("quality") == 1).alias("remote_verified"),
        F.concat(F.lit("run-"), F.col("lang")).alias("remote_verified_at"),
        (key * 10 + F.col("n_chars") % 30).alias("manifest_mtime"),
    )


def doc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as members of archives, one archive per source."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("source").alias("archive"),
        F.concat(F.lit("m"), F.col("doc_id").cast("string")).alias("name"),
        F.sha2("text", 256).alias("sha256"),
    )


CUSTOMERS_PER_FEED = 200


def feed_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as zipped feeds, one per block of customers, packed inside tasks (snapshot, content).

    Some feeds aren't archives, lack members or a column, begin with a byte-order
    mark; some rows are short, some names hold quotes, commas and line ends.
    """

    def packed(key, rows):
        block = key[0].as_py()
        buffer = io.BytesIO()
        trips = [["trip_id", "route_id", "service_id", "shape_id"][: 3 if block % 5 == 3 else 4]]
        routes, versions = [["route_type", "route_id", "route_short_name"]], [["feed_version"]]
        for row in sorted(rows.to_pylist(), key=lambda r: r["c_custkey"]):
            n = row["c_custkey"]
            trip = [f"T{n}", f"R{row['c_nationkey']}", row["c_mktsegment"], f"S{n % 7}"]
            trips.append(trip[: 3 if block % 5 == 3 or n % 11 == 0 else 4])
            routes.append(["x" if n % 17 == 3 else n % 4, f"R{n}", f'{row["c_name"]}, "{n}"\n' if n % 3 == 0 else row["c_name"]])
            versions.append([f"v{n}"])
        members = {"trips.txt": trips, "shapes.txt": [["shape_id"]], "stops.txt": [["stop_id"]]}
        if block % 7 != 2:
            members["routes.txt"] = routes
        if block % 4 == 1:
            del members["stops.txt"]
        if block % 3 == 0:
            members["feed_info.txt"] = versions
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for name, lines in members.items():
                text = io.StringIO(newline="")
                csv.writer(text).writerows(lines)
                archive.writestr(name, ("\ufeff" if block % 2 else "") + text.getvalue())
        content = b"not an archive" if block % 13 == 5 else buffer.getvalue()
        return pa.table({"snapshot": pa.array([f"f{block}"]), "content": pa.array([content], pa.binary())})

    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    blocks = customers.withColumn("block", F.floor(F.col("c_custkey") / CUSTOMERS_PER_FEED))
    return cut_lineage(blocks.groupBy("block").applyInArrow(packed, "snapshot string, content binary"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as capture runs of five networks: refused, empty and repeating answers."""
    events = event_seconds(table(spark, sf_dir, "events"))
    items = F.floor("value") % 3
    return events.select(
        F.col("event_type").alias("city"),
        "snapshot_ts",
        "event_id",
        F.when(items == 0, F.sha2(F.lit(""), 256))
        .otherwise(F.sha2(F.concat(items.cast("string"), (F.col("event_id") % 2).cast("string")), 256))
        .alias("digest"),
        items.alias("items"),
        (F.col("user_id") % 10 != 0).alias("accepted"),
    )


RUN_KEYS, RUN_ORDER = ["city"], ["snapshot_ts", "event_id"]


def run_bucket():
    return F.floor(F.col("snapshot_ts") / 21600)


NOW_UTC = "2024-01-30 20:07:00"


def hour_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file name per event second, with a digest and the role it plays."""
    events = table(spark, sf_dir, "events")
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HHmmss")
    named = events.select(
        F.concat(F.lit("tu_"), stamp, F.lit("Z.pb")).alias("name"), "event_id", "props"
    )
    first = named.groupBy("name").agg(
        F.min("event_id").alias("event_id"), F.min_by("props", "event_id").alias("props")
    )
    return first.select("name", F.sha2("props", 256).alias("sha256"), (F.col("event_id") % 6).alias("role"))


def hour_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = hour_files(spark, sf_dir).filter("role IN (0, 1, 2)")
    return held.select(hour_of_name(F.col("name")).alias("hour"), "name", "sha256")


def hour_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late files, exact repeats (role 0) and namesakes with other bytes (role 1)."""
    files = hour_files(spark, sf_dir).filter("role <> 2")
    return files.select(
        "name",
        F.when(F.col("role") == 1, F.sha2(F.concat("sha256", F.lit("x")), 256)).otherwise(F.col("sha256")).alias("sha256"),
    )


def doc_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests seen at the origin: some files differ, some are gone."""
    docs = table(spark, sf_dir, "documents")
    key = F.col("doc_id")
    data = docs.filter(key % 11 != 2).select(
        F.concat(F.lit("d"), key.cast("string")).alias("file"),
        F.sha2(F.when(key % 7 == 1, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256).alias("sha256"),
    )
    polls_seen = docs.filter((key % 3 == 0) & (key % 13 != 3)).select(
        F.concat(F.lit("p"), key.cast("string")).alias("file"),
        F.sha2(F.when(key % 5 == 1, F.lit("other")).otherwise(F.col("source")), 256).alias("sha256"),
    )
    return data.unionByName(polls_seen)
