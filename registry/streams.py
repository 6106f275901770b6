"""Streaming forms of registered queries; their SQL is that of the batch forms.

Each drains the driver's tables as a file stream into a fresh folder below the
session's shared one and returns the table the stream left.
"""

from __future__ import annotations

import gzip
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

import driver_views as views
from fleetgrain.functions.clock import local_time
from fleetgrain.operators import walk as walk_ops
from fleetgrain.session import shared_dir
from fleetgrain.sources import jsonl
from fleetgrain.streaming import capture, ingest, walk
from registry import files, quality, walking
from registry.common import steps, walk_plan, walk_shapes, walk_trips

ONCE = {"availableNow": True}
FILES_PER_PART = 4


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _sliced(df, folder, name, by):
    """Land a table in three parts one after another in order of `by`, of some files each; a part is one micro-batch."""
    spark = df.sparkSession
    path = f"{folder}/{name}"
    third = df.agg(F.percentile_approx(by, F.array(F.lit(1 / 3), F.lit(2 / 3))).alias("c")).first()["c"]
    spot = F.col(by)
    for part in (spot <= third[0], (spot > third[0]) & (spot <= third[1]), spot > third[1]):
        df.filter(part).repartition(FILES_PER_PART).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", FILES_PER_PART).parquet(path)


def _drain(query):
    query.awaitTermination()


def stream_poll_ingest(spark, sf_dir):
    """Decoded polls land as JSON and come out as heartbeats by local date."""
    out = _folder(spark, "ingest")
    landed = f"{out}/landed"
    views.decoded_polls(spark, sf_dir).repartition(4, "poll_ts").write.json(landed)
    _drain(
        ingest.start_ingest(
            ingest.poll_stream(spark, landed, 2), out, f"{out}/checkpoint", views.TZ, views.box(), ONCE
        )
    )
    beats = spark.read.parquet(f"{out}/polls")
    records = spark.read.parquet(f"{out}/positions").groupBy("snapshot_ts").agg(F.count(F.lit(1)).alias("records"))
    return beats.join(records, "snapshot_ts", "left").select(
        "service_date", "snapshot_ts", "vehicle_count", "entities_total", F.coalesce("records", F.lit(0)).alias("records")
    )


INGEST_SQL = f"""WITH {quality.ENTITIES}
SELECT CAST(timezone('{views.TZ}', to_timestamp(poll_ts)) AS DATE) AS service_date, poll_ts AS snapshot_ts,
       count(CASE WHEN inside THEN 1 END) AS vehicle_count, count(CASE WHEN has_vehicle THEN 1 END) AS entities_total, count(CASE WHEN inside THEN 1 END) AS records
FROM x GROUP BY poll_ts"""


def stream_alert_capture(spark, sf_dir):
    out = _folder(spark, "capture")
    runs = _sliced(views.runs(spark, sf_dir), out, "landed", "snapshot_ts")
    _drain(capture.start_capture(runs, out, f"{out}/checkpoint", views.RUN_ORDER, views.run_bucket, ONCE))
    return spark.read.parquet(f"{out}/runs").select("city", "event_id", "items", "accepted", "kept")


def stream_static_capture(spark, sf_dir):
    """Kept feeds with their names, numbered within a local day over all batches."""
    out = _folder(spark, "static")
    runs = _sliced(views.runs(spark, sf_dir), out, "landed", "snapshot_ts")
    local = lambda: local_time(F.col("snapshot_ts"), views.TZ)
    _drain(capture.start_static_capture(runs, out, f"{out}/checkpoint", views.RUN_ORDER, views.run_bucket, local, ONCE))
    return spark.read.parquet(f"{out}/static").select("city", "event_id", "snapshot")


def stream_hour_compaction(spark, sf_dir):
    """Every file arrives as incoming; the archive after all batches."""
    out = _folder(spark, "hours")
    second = F.unix_timestamp(F.substring("name", 4, 17), "yyyy-MM-dd'T'HHmmss")
    rows = views.hour_files(spark, sf_dir).select("name", "sha256", second.alias("second"))
    incoming = _sliced(rows, out, "landed", "second")
    _drain(
        capture.start_compaction(
            incoming, out, f"{out}/checkpoint", lambda: F.lit(views.NOW_UTC).cast("timestamp"), ONCE
        )
    )
    return spark.read.parquet(f"{out}/archive").select(
        F.col("hour").cast("string").alias("hour"), "name", "sha256"
    )


COMPACTION_SQL = f"""WITH {files.HOURS}
SELECT hour, name, sha256 FROM roles WHERE hour < strftime(TIMESTAMP '{views.NOW_UTC}', '%Y-%m-%dT%H')"""


def stream_trip_walk(spark, sf_dir):
    out = _folder(spark, "walk")
    landed = _sliced(views.positions(spark, sf_dir), out, "landed", "snapshot_ts")
    _drain(
        walk.start_walk(
            landed,
            walk_plan(spark, sf_dir),
            walk_trips(spark, sf_dir),
            walk_shapes(spark, sf_dir),
            views.WALK,
            ["seq"],
            out,
            f"{out}/checkpoint",
            ONCE,
        )
    )
    return spark.read.parquet(f"{out}/steps").select(
        "service_date",
        "vehicle_id",
        "snapshot_ts",
        F.col("n").alias("records"),
        "verdict",
        "from_ts",
        F.round("dist_m", 3).alias("dist_m"),
        F.round("delta_m", 3).alias("delta_m"),
    )


def stream_typical_bins(spark, sf_dir):
    out = _folder(spark, "typical")
    samples = walk_ops.samples(steps(spark, sf_dir), views.WALK)
    landed = _sliced(samples, out, "landed", "to_ts")
    _drain(walk.start_typical(landed, walk_plan(spark, sf_dir), out, f"{out}/checkpoint", ONCE))
    return spark.read.parquet(f"{out}/bins").withColumn("period_key", F.col("period_key").cast("string"))


def json_lines_round_trip(spark, sf_dir):
    """Positions written as one gzip file a day, its last line torn, and read back by the day files' own reader.

    Fixes keep the order they were written in, which the first and last event show.
    """
    folder = _folder(spark, "lines")
    rows = views.positions(spark, sf_dir)
    lines = rows.select("service_date", "seq", F.to_json(F.struct(*[c for c in rows.columns if c != "service_date"])).alias("line"))
    ordered = lines.repartition("service_date").sortWithinPartitions("service_date", "seq").select("service_date", "line")
    ordered.mapInArrow(_write_day_files(folder), "written string").count()
    good = jsonl.read_positions(spark, folder)
    return good.groupBy("service_date").agg(
        F.count(F.lit(1)).alias("records"),
        F.count("vehicle_id").alias("with_vehicle"),
        F.count_if(F.col("trip_id") == "").alias("blank_trip"),
        F.sum("snapshot_ts").alias("stamps"),
        F.min_by("snapshot_ts", "file_spot").alias("first_stamp"),
        F.max_by("snapshot_ts", "file_spot").alias("last_stamp"),
    )


def _write_day_files(folder):
    """A kernel that writes sorted (service_date, line) rows as <date>.jsonl.gz, whole days per task."""

    def run(batches):
        system, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(path, recursive=True)
        day, out = None, None
        for batch in batches:
            for date, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if date != day:
                    if out:
                        out.write(b'{"torn')
                        out.close()
                    day, out = date, gzip.open(system.open_output_stream(f"{path}/{date}.jsonl.gz", compression=None), "wb")
                out.write(line.encode() + b"\n")
        if out:
            out.write(b'{"torn')
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([path])], ["written"])

    return run


LINES_SQL = f"""WITH RECURSIVE {walking.FIXES}
SELECT service_date, count(*) AS records, count(CASE WHEN has_vehicle THEN 1 END) AS with_vehicle, count(CASE WHEN NOT has_trip THEN 1 END) AS blank_trip,
       CAST(sum(snapshot_ts) AS BIGINT) AS stamps, arg_min(snapshot_ts, event_id) AS first_stamp,
       arg_max(snapshot_ts, event_id) AS last_stamp
FROM pos GROUP BY service_date"""


QUERIES = {
    "stream_poll_ingest": (stream_poll_ingest, INGEST_SQL),
    "stream_alert_capture": (stream_alert_capture, files.CAPTURE_SQL),
    "stream_static_capture": (stream_static_capture, files.STATIC_SQL),
    "stream_hour_compaction": (stream_hour_compaction, COMPACTION_SQL),
    "stream_trip_walk": (stream_trip_walk, walking.TRIP_WALK_SQL),
    "stream_typical_bins": (stream_typical_bins, walking.TYPICAL_SQL),
    "json_lines_round_trip": (json_lines_round_trip, LINES_SQL),
}
