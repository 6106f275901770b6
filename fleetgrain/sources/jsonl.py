"""Line-delimited JSON: positions, heartbeats, manifests and decoded entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrain.functions.clock import date_in
from fleetgrain.functions.geo import inside_box
from fleetgrain.functions.keys import split_bin_key

POSITION_SCHEMA = """
  snapshot_ts BIGINT, vehicle_id STRING, route_id STRING, trip_id STRING, lat DOUBLE, lon DOUBLE,
  bearing DOUBLE, speed_ms DOUBLE, vehicle_ts BIGINT, stop_id STRING, current_status STRING,
  occupancy_status STRING, congestion_level STRING, schedule_relationship STRING,
  _corrupt_record STRING
"""
POLL_SCHEMA = """
  snapshot_ts BIGINT, fetch_ok BOOLEAN, vehicle_count BIGINT, entities_total BIGINT,
  vehicles_with_position BIGINT, dropped_out_of_bbox BIGINT, _corrupt_record STRING
"""
MANIFEST_SCHEMA = """
  schema_version INT, date STRING, data_file STRING, data_sha256 STRING, data_size_bytes BIGINT,
  compressed BOOLEAN, total_vehicle_records BIGINT, data_malformed_lines BIGINT,
  heartbeat_available BOOLEAN, day_in_progress BOOLEAN, polls_file STRING, polls_sha256 STRING,
  polls_malformed_lines BIGINT, polls_logged BIGINT, successful_polls BIGINT, empty_polls BIGINT,
  fetch_error_polls BIGINT, entities_total BIGINT, vehicles_with_position BIGINT,
  dropped_out_of_bbox BIGINT, dropped_out_of_bbox_pct DOUBLE, heartbeat_partial BOOLEAN,
  nominal_interval_sec INT, observed_interval_sec DOUBLE, gap_count BIGINT,
  gaps ARRAY<STRUCT<after_ts: BIGINT, before_ts: BIGINT, gap_seconds: BIGINT>>,
  day_seconds BIGINT, local_lag_sec BIGINT, expected_polls DOUBLE, coverage_pct DOUBLE,
  remote_verified BOOLEAN, remote_verified_at STRING, remote_verify_note STRING
"""
POLL_ROWS = """
  service_date DATE, snapshot_ts BIGINT, fetch_ok BOOLEAN, vehicle_count BIGINT, entities_total BIGINT,
  vehicles_with_position BIGINT, dropped_out_of_bbox BIGINT
"""
ENTITY_SCHEMA = """
  poll_ts BIGINT, fetch_ok BOOLEAN, entity ARRAY<STRUCT<vehicle: STRUCT<
    vehicle: STRUCT<id: STRING>,
    trip: STRUCT<trip_id: STRING, route_id: STRING, schedule_relationship: STRING>,
    position: STRUCT<latitude: DOUBLE, longitude: DOUBLE, bearing: DOUBLE, speed: DOUBLE>,
    timestamp: BIGINT, stop_id: STRING, current_status: STRING, occupancy_status: STRING,
    congestion_level: STRING>>>
"""
_DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})\.[^/]*$"


def _scan(spark: SparkSession, paths: list[str] | str, schema: str) -> DataFrame:
    """Torn lines land in _corrupt_record, blank ones vanish, .gz opens by itself.

    The service date is the file's own, null where the name holds no real date.
    `file_spot` orders records within a file: a later block starts further on,
    blocks are far more than 64 bytes apart, and rows count up inside one.
    """
    lines = spark.read.text(paths).filter(F.trim("value") != "")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))  # without the task's number
    spots = lines.select(
        date_in(F.col("_metadata.file_path"), _DATE_IN_NAME).alias("service_date"),
        F.col("_metadata.file_name").alias("file"),
        (F.shiftleft(F.col("_metadata.file_block_start"), 27) + row).alias("file_spot"),
        "value",
    )
    return parse_lines(spots, "value", schema).select(*spots.columns[:-1], "record.*")


def read_positions(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    return whole_lines(_scan(spark, paths, POSITION_SCHEMA))


def whole_lines(scan: DataFrame) -> DataFrame:
    return scan.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


FILE_ORDER = ["file_spot"]


def read_polls(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Heartbeats; fields old files lack count as zero."""
    polls = whole_lines(_scan(spark, paths, POLL_SCHEMA))
    later = ["entities_total", "vehicles_with_position", "dropped_out_of_bbox"]
    return polls.fillna(0, later)


def line_counts(spark: SparkSession, paths: list[str] | str, schema: str = POSITION_SCHEMA) -> DataFrame:
    """(file, records, malformed) per file."""
    bad = F.col("_corrupt_record").isNotNull()
    return _scan(spark, paths, schema).groupBy("file").agg(
        F.count_if(~bad).alias("records"), F.count_if(bad).alias("malformed")
    )


def read_manifests(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    return (
        spark.read.schema(MANIFEST_SCHEMA)
        .option("multiLine", True)
        .json(paths)
        .withColumn("service_date", F.to_date("date"))
        .drop("date")
    )


def read_period_document(spark: SparkSession, path: str) -> DataFrame:
    """Bins out of a period document: nested maps of `shape|segment|slot` keys per period."""
    cell = "STRUCT<median_speed_ms: DOUBLE, n_samples: BIGINT>"
    schema = f"segments MAP<STRING, MAP<STRING, {cell}>>"
    document = spark.read.schema(schema).option("multiLine", True).json(path)
    periods = document.select(F.explode("segments").alias("period_key", "bins"))
    cells = periods.select("period_key", F.explode("bins").alias("bin", "cell"))
    return cells.select("period_key", *split_bin_key(F.col("bin")), "cell.median_speed_ms", "cell.n_samples")


def parse_lines(lines: DataFrame, text: str, schema: str) -> DataFrame:
    """Tolerant parse of a text column: `record` is null where a line is torn."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return lines.withColumn("record", F.from_json(F.col(text), schema, options))


def vehicle_records(polls: DataFrame) -> DataFrame:
    """One row per positioned vehicle entity of decoded polls, absent fields null."""
    v = F.col("v.vehicle")
    rows = polls.select("poll_ts", F.explode("entity").alias("v")).filter(v["position"].isNotNull())
    trip, pos = v["trip"], v["position"]
    return rows.select(
        F.col("poll_ts").alias("snapshot_ts"),
        v["vehicle"]["id"].alias("vehicle_id"),
        trip["route_id"].alias("route_id"),
        trip["trip_id"].alias("trip_id"),
        F.bround(pos["latitude"], 6).alias("lat"),
        F.bround(pos["longitude"], 6).alias("lon"),
        pos["bearing"].alias("bearing"),
        F.bround(pos["speed"], 2).alias("speed_ms"),
        v["timestamp"].alias("vehicle_ts"),
        v["stop_id"].alias("stop_id"),
        v["current_status"].alias("current_status"),
        v["occupancy_status"].alias("occupancy_status"),
        v["congestion_level"].alias("congestion_level"),
        trip["schedule_relationship"].alias("schedule_relationship"),
        pos["latitude"].alias("_lat"),
        pos["longitude"].alias("_lon"),
    )


def records_inside(records: DataFrame, box: Column) -> DataFrame:
    """Records whose unrounded position lies in the box."""
    return records.filter(inside_box(F.col("_lat"), F.col("_lon"), box)).drop("_lat", "_lon")


def poll_audit(polls: DataFrame, box: Column) -> DataFrame:
    """One heartbeat per poll: entities, positioned, inside, dropped. No shuffle."""
    entities = F.filter("entity", lambda e: e["vehicle"].isNotNull())
    placed = F.filter(entities, lambda e: e["vehicle"]["position"].isNotNull())
    inside = F.filter(
        placed,
        lambda e: inside_box(
            e["vehicle"]["position"]["latitude"], e["vehicle"]["position"]["longitude"], box
        ),
    )

    def size(col: Column) -> Column:
        return F.when(F.col("fetch_ok"), F.greatest(F.size(F.coalesce(col, F.array())), F.lit(0))).otherwise(0)

    return polls.select(
        F.col("poll_ts").alias("snapshot_ts"),
        "fetch_ok",
        size(inside).cast("bigint").alias("vehicle_count"),
        size(entities).cast("bigint").alias("entities_total"),
        size(placed).cast("bigint").alias("vehicles_with_position"),
        (size(placed) - size(inside)).cast("bigint").alias("dropped_out_of_bbox"),
    )
