"""Streams against their batch forms, over restarts and repeated micro-batches."""

import datetime as dt
import json
from pathlib import Path

from pyspark.sql import functions as F

from fleetgrain.operators import bins, capture as batch, walk
from fleetgrain.params import WalkParams
from fleetgrain.streaming import capture, ingest, walk as walks
from fleetgrain.streaming.state import BatchState
from tests.helpers import TZ, line_shapes, plan_and_trips

ONCE = {"availableNow": True}
RUNS = "city string, ts bigint, digest string, items bigint, accepted boolean"


def _land(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def _forget_last_commit(checkpoint):
    commits = [p for p in Path(checkpoint, "commits").iterdir() if p.name.isdigit()]
    last = max(commits, key=lambda p: int(p.name))
    last.unlink()
    Path(checkpoint, "commits", f".{last.name}.crc").unlink(missing_ok=True)


def _bucket():
    return F.floor(F.col("ts") / 3)


def test_capture_over_restarts_and_a_repeated_batch(spark, tmp_path):
    digests = {"a": ("x", 1), "b": ("y", 2), "-": ("none", 0), "!": (None, None)}
    logs = {"one": "aab-a--!-", "two": "--!--ab", "three": "a!a"}
    rows = [
        (city, i, *digests[c], c != "!") for city, log in logs.items() for i, c in enumerate(log)
    ]
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))

    def drain():
        stream = spark.readStream.schema(RUNS).option("maxFilesPerTrigger", 1).parquet(landed)
        capture.start_capture(stream, out, checkpoint, ["ts"], _bucket, ONCE).awaitTermination()

    for cut in ((0, 3), (3, 4), (4, 6), (6, 99)):
        _land(spark, [r for r in rows if cut[0] <= r[1] < cut[1]], RUNS, landed)
        drain()
    _forget_last_commit(checkpoint)
    drain()
    whole = batch.capture_alerts(spark.createDataFrame(rows, RUNS), ["city"], ["ts"], _bucket())
    want = {(r["city"], r["ts"], r["kept"]) for r in whole.collect()}
    got = [(r["city"], r["ts"], r["kept"]) for r in spark.read.parquet(f"{out}/runs").collect()]
    assert len(got) == len(rows) and set(got) == want
    kept = {city: "".join(log[t] for c, t, k in sorted(want) if c == city and k) for city, log in logs.items()}
    assert kept == {"one": "aba-", "two": "-ab", "three": "a"}


def test_static_capture_over_restarts_days_and_a_repeated_batch(spark, tmp_path):
    """Names equal those of the whole log, however it is cut; a day's numbers go on over batches and start anew with the next."""
    schema = "city string, ts long, digest string"
    noon, hour = 1_790_000_000 // 86_400 * 86_400 + 9 * 3600, 3600
    logs = {"one": "aabab--aacc", "two": "----aaabab", "three": "bbbbbbbbbbbbbb"}
    rows = [(city, noon + 3 * hour * i, None if c == "-" else c) for city, log in logs.items() for i, c in enumerate(log)]
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))
    local = lambda: F.col("ts").cast("timestamp")

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
        capture.start_static_capture(stream, out, checkpoint, ["ts"], _bucket, local, ONCE).awaitTermination()

    def named(df):
        return sorted((r["city"], r["ts"], r["snapshot"]) for r in df.select("city", "ts", "snapshot").collect())

    for cut in ((0, 2), (2, 3), (3, 4), (4, 9), (9, 99)):
        _land(spark, [r for r in rows if cut[0] <= (r[1] - noon) // (3 * hour) < cut[1]], schema, landed)
        drain()
    _forget_last_commit(checkpoint)
    drain()
    changed = batch.keep_changes(spark.createDataFrame(rows, schema), ["city"], ["ts"], _bucket())
    whole = batch.name_snapshots(changed.filter("kept"), ["city"], ["ts"], local())
    got = named(spark.read.parquet(f"{out}/static"))
    assert got == named(whole)
    of_one = [name.removeprefix("gtfs_") for city, _, name in got if city == "one"]
    assert len({name[:10] for name in of_one}) > 1 and sum("T" not in name for name in of_one) == len({n[:10] for n in of_one})
    assert [city for city, _, _ in got].count("three") == 1


def test_compaction_waits_merges_late_files_and_repeats_safely(spark, tmp_path):
    schema = "name string, sha256 string"
    stamp = "tu_2026-10-17T{}Z.pb".format
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))
    clock = {"now": "2026-10-17 10:07:00"}

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
        now = lambda: F.lit(clock["now"]).cast("timestamp")
        capture.start_compaction(stream, out, checkpoint, now, ONCE).awaitTermination()

    def held():
        return {(r["hour"], r["name"]) for r in spark.read.parquet(f"{out}/archive").collect()}

    _land(spark, [(stamp("090015"), "a"), (stamp("090145"), "b"), (stamp("100015"), "c")], schema, landed)
    drain()
    nine = {("2026-10-17T09", stamp("090015")), ("2026-10-17T09", stamp("090145"))}
    assert held() == nine
    # late, repeated and conflicting files; meanwhile hour ten has closed
    clock["now"] = "2026-10-17 11:02:00"
    _land(spark, [(stamp("090100"), "d"), (stamp("090015"), "a"), (stamp("090145"), "other")], schema, landed)
    drain()
    full = nine | {("2026-10-17T09", stamp("090100")), ("2026-10-17T10", stamp("100015"))}
    assert held() == full
    waiting = BatchState(spark, f"{out}/waiting", schema).before(2)
    assert [tuple(r) for r in waiting.collect()] == [(stamp("090145"), "other")]
    _forget_last_commit(checkpoint)
    drain()
    assert held() == full
    assert spark.read.parquet(f"{out}/archive").count() == 4


POSITIONS = (
    "service_date date, vehicle_id string, trip_id string, snapshot_ts bigint, lat double, lon double, speed_ms double, seq bigint"
)


def _walk_case(spark):
    shapes, key = line_shapes(spark)
    days = [dt.date(2026, 9, d) for d in (1, 2, 7)]
    plan = spark.createDataFrame([(d, "a", "b") for d in days], "service_date date, snapshot string, next_snapshot string")
    trips = plan_and_trips(spark, [("T1", "R1", "S1", key)])[1]
    rows = []
    for n, day in enumerate(days):
        start = 1000 + 86400 * n
        rows += [(day, f"V{v}", "T1", start + 45 * i, 0.0005 * (i + v), 0.0, 3.0, 100 * n + 10 * v + i) for v in range(2) for i in range(8)]
    return shapes, plan, trips, rows, days


STEP = ["service_date", "vehicle_id", "snapshot_ts", "n", "verdict", "from_ts", "dist_m"]


def test_walk_over_restarts_late_days_and_a_repeated_batch(spark, tmp_path):
    shapes, plan, trips, rows, days = _walk_case(spark)
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))
    params = WalkParams(timezone=TZ)

    def drain():
        stream = spark.readStream.schema(POSITIONS).option("maxFilesPerTrigger", 1).parquet(landed)
        walks.start_walk(stream, plan, trips, shapes, params, ["seq"], out, checkpoint, ONCE).awaitTermination()

    early = [r for r in rows if r[3] % 86400 < 1000 + 45 * 4]
    # the rest of the first day comes after a day six days later was walked
    parts = [[r for r in early if r[0] == days[0]], [r for r in rows if r[0] != days[0]]]
    parts.append([r for r in rows if r[0] == days[0] and r not in early])
    for part in parts:
        _land(spark, part, POSITIONS, landed)
        drain()
    _forget_last_commit(checkpoint)
    drain()
    whole = walk.walk(spark.createDataFrame(rows, POSITIONS), plan, trips, shapes, params, ["seq"])
    got = sorted(map(str, spark.read.parquet(f"{out}/steps").select(*STEP).collect()))
    assert got == sorted(map(str, whole.select(*STEP).collect()))
    assert {r["verdict"] for r in whole.collect()} >= {walk.HEAD, walk.ACCEPTED}
    for day in Path(out, "anchors").glob("service_date=*"):
        assert len(list(day.glob("batch=*"))) <= 2


def test_typical_bins_over_restarts_and_a_repeated_batch(spark, tmp_path):
    schema = (
        "service_date date, shape_key string, segment_index int, timeslot string, speed_raw double"
    )
    days = [dt.date(2026, 9, d) for d in (1, 2, 3, 5)]
    plan = spark.createDataFrame([(d, "p" if d.day < 3 else "q" if d.day == 3 else None) for d in days], "service_date date, period_key string")
    rows = [(d, f"k{i % 3}", i % 2, "08:00", float(d.day * i % 11)) for d in days for i in range(12)]
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
        walks.start_typical(stream, plan, out, checkpoint, ONCE).awaitTermination()

    # the second batch touches one bin of the first period only, the last none at all
    for part in (rows[:20], [r for r in rows[20:] if r[1] == "k0" and r[0] != days[3]], [r for r in rows[20:] if r[1] != "k0"], rows[:0] + [rows[-1]]):
        _land(spark, part, schema, landed)
        drain()
    _forget_last_commit(checkpoint)
    drain()
    seen = rows[:20] + [r for r in rows[20:] if r[1] == "k0" and r[0] != days[3]] + [r for r in rows[20:] if r[1] != "k0"] + [rows[-1]]
    want = bins.typical_bins(spark.createDataFrame(seen, schema), plan)
    names = want.columns
    got = spark.read.parquet(f"{out}/bins").select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ingest_over_a_restart_and_a_repeated_batch(spark, tmp_path):
    landed, out, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "checkpoint"))
    Path(landed).mkdir()
    box = F.struct(*[F.lit(v).alias(n) for n, v in (("lat_min", 0.0), ("lat_max", 9.0), ("lon_min", 0.0), ("lon_max", 9.0))])

    def land(name, ts, lats):
        entity = [{"vehicle": {"vehicle": {"id": f"V{i}"}, "position": {"latitude": lat, "longitude": 1.0}}} for i, lat in enumerate(lats)]
        Path(landed, name).write_text(json.dumps({"poll_ts": ts, "fetch_ok": True, "entity": entity}) + "\n")

    def drain():
        stream = ingest.poll_stream(spark, landed, 1)
        ingest.start_ingest(stream, out, checkpoint, "UTC", box, ONCE).awaitTermination()

    land("a.json", 1_790_000_000, [1.0, 2.0, 50.0])
    drain()
    land("b.json", 1_790_000_045, [3.0])
    land("c.json", 1_789_900_000, [4.0, 5.0])
    drain()
    _forget_last_commit(checkpoint)
    drain()
    polls = {r["snapshot_ts"]: (r["vehicle_count"], r["dropped_out_of_bbox"]) for r in spark.read.parquet(f"{out}/polls").collect()}
    assert polls == {1_790_000_000: (2, 1), 1_790_000_045: (1, 0), 1_789_900_000: (2, 0)}
    assert spark.read.parquet(f"{out}/positions").count() == 5 and spark.read.parquet(f"{out}/polls").count() == 3
