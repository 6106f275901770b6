import csv
import datetime as dt
import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from fleetgrain.operators import capture, digests, reconcile
from fleetgrain.sources import gtfs, jsonl, listings

MANIFEST = (
    "service_date date, data_file string, data_sha256 string, polls_file string, polls_sha256 string, "
    "day_in_progress boolean, schema_version int, remote_verified boolean, remote_verified_at string, "
    "manifest_mtime bigint"
)


def _day(n):
    return dt.date(2026, 9, n)


def _manifests(spark, rows):
    base = {"data": "x", "polls_file": None, "polls": None, "open": False, "schema": 2, "ok": None, "mtime": 10}
    full = []
    for n, changes in rows.items():
        r = {**base, **changes}
        full.append((_day(n), f"d{n}", r["data"], r["polls_file"], r["polls"], r["open"], r["schema"], r["ok"], "t", r["mtime"]))
    return spark.createDataFrame(full, MANIFEST)


def test_verdicts(spark):
    manifests = _manifests(
        spark,
        {1: {}, 2: {}, 3: {"open": True}, 4: {"ok": True}, 5: {}, 6: {"polls_file": "p6", "polls": "y"},
         7: {"polls_file": "p7", "polls": "y"}, 8: {"polls_file": "p8", "polls": "y"}},
    )
    seen = [("d1", "x"), ("d2", "other"), ("d3", "other"), ("d4", "other"), ("d6", "x"), ("p6", "y"),
            ("d7", "x"), ("p7", "z"), ("d8", "x")]
    observed = spark.createDataFrame(seen, "file string, sha256 string")
    rows = {r["service_date"].day: (r["verdict"], r["remote_verified"], r["note"])
            for r in reconcile.verify(manifests, observed).collect()}
    assert rows == {
        1: ("match", True, None),
        2: ("mismatch", False, "data_sha256"),
        5: ("not_found", None, None),
        6: ("match", True, None),
        7: ("mismatch", False, "polls_sha256"),
        8: ("not_found", None, None),
    }


def test_carry(spark):
    old = _manifests(spark, {1: {"ok": True}, 2: {"ok": False}, 3: {"ok": True}, 4: {}})
    new = _manifests(spark, {1: {}, 2: {}, 3: {"data": "moved"}, 4: {}, 5: {}}).drop("remote_verified", "remote_verified_at")
    rows = {r["service_date"].day: r["remote_verified"] for r in reconcile.carry_verification(new, old).collect()}
    assert rows == {1: True, 2: None, 3: None, 4: None, 5: None}


def test_stale_and_gate(spark):
    manifests = _manifests(
        spark, {1: {}, 2: {"schema": 1}, 3: {"schema": None}, 4: {"ok": False}, 5: {"mtime": 1}, 6: {"mtime": 4}, 8: {"open": True}}
    )
    inputs = spark.createDataFrame(
        [(_day(n), 3, 5 if n == 6 else None) for n in range(1, 8)],
        "service_date date, data_mtime bigint, polls_mtime bigint",
    )
    rows = {r["service_date"].day: r["reason"] for r in reconcile.stale(manifests, inputs).collect()}
    assert rows == {2: "schema", 3: "schema", 4: "failed_check", 5: "data_newer", 6: "polls_newer", 7: "missing"}
    gate = reconcile.gate_violations(manifests)
    assert {(r["service_date"].day, r["reason"]) for r in gate.collect()} == {(2, "schema"), (3, "schema"), (8, "in_progress")}
    with pytest.raises(ValueError, match="gate"):
        reconcile.require_empty(gate, "gate")
    reconcile.require_empty(gate.filter("false"), "gate")


def test_ranges(spark):
    manifests = _manifests(spark, {1: {}, 3: {}})
    ranges = spark.createDataFrame([(_day(1), _day(3))], "start_date date, end_date date")
    assert [r["service_date"] for r in reconcile.missing_days(ranges, manifests).collect()] == [_day(2)]
    with pytest.raises(ValueError):
        reconcile.check_range("2026-09-03", "2026-09-01")
    with pytest.raises(ValueError):
        reconcile.newest_bundles(manifests, 0, [])


def test_day_files_and_selection(spark):
    names = ["2026-09-01.jsonl.gz", "2026-09-01.jsonl", "2026-09-02.jsonl.gz", "2026-09-02.polls.jsonl", "x.jsonl"]
    files = spark.createDataFrame([(n,) for n in names], "name string")
    days = reconcile.choose_day_files(files)
    assert {(r["service_date"].day, r["name"]) for r in days.collect()} == {(1, names[1]), (2, names[2])}
    today = F.lit(_day(2))
    assert reconcile.selected_days(days, today).count() == 1
    assert reconcile.selected_days(days, today, ["2026-09-02"]).first()["service_date"] == _day(2)
    asked = spark.createDataFrame([(_day(2),)], "service_date date")
    plan = reconcile.planning_days(days, today, asked)
    assert {(r["service_date"].day, r["processed"]) for r in plan.collect()} == {(1, False), (2, True)}


DAY_TEXT = (
    '{"snapshot_ts": 1000, "vehicle_id": "V1", "trip_id": "T1", "lat": 1.0, "lon": 2.0, "speed_ms": 3.5}\n'
    "\n"
    '{"snapshot_ts": 1045, "vehicle_id": "V1", "trip_id": "T1", "lat": 1.1, "lon": 2.0, "occupancy_status": "EMPTY"}\n'
    '{"snapshot_ts": 1090, "vehic'
)


def test_day_files_plain_and_gzip(spark, tmp_path):
    (tmp_path / "2026-09-01.jsonl").write_text(DAY_TEXT)
    with gzip.open(tmp_path / "2026-09-02.jsonl.gz", "wt") as out:
        out.write(DAY_TEXT)
    paths = [str(p) for p in sorted(tmp_path.iterdir())]
    rows = jsonl.read_positions(spark, paths).orderBy("service_date", *jsonl.FILE_ORDER).collect()
    assert [(r["service_date"].day, r["snapshot_ts"]) for r in rows] == [(1, 1000), (1, 1045), (2, 1000), (2, 1045)]
    assert rows[0]["occupancy_status"] is None and rows[1]["occupancy_status"] == "EMPTY"
    counts = {r["file"]: (r["records"], r["malformed"]) for r in jsonl.line_counts(spark, paths).collect()}
    assert set(counts.values()) == {(2, 1)} and len(counts) == 2
    listed = {r["name"]: r for r in listings.list_files(spark, str(tmp_path)).collect()}
    assert listed["2026-09-01.jsonl"]["bytes"] == len(DAY_TEXT)
    found = {r["file"]: r for r in digests.file_digests(listings.file_contents(spark, str(tmp_path), "*.jsonl*")).collect()}
    want = hashlib.sha256(DAY_TEXT.encode()).hexdigest()
    assert {r["sha256"] for r in found.values()} == {want}
    assert {r["size_bytes"] for r in found.values()} == {len(DAY_TEXT)}


def test_old_heartbeats_read_as_zero(spark, tmp_path):
    (tmp_path / "2026-09-01.polls.jsonl").write_text('{"snapshot_ts": 1, "fetch_ok": true, "vehicle_count": 4}\n{"snap')
    row = jsonl.read_polls(spark, str(tmp_path)).collect()
    assert len(row) == 1
    assert (row[0]["vehicle_count"], row[0]["entities_total"], row[0]["dropped_out_of_bbox"]) == (4, 0, 0)
    assert row[0]["service_date"] == _day(1)


def test_manifest_scan(spark, tmp_path):
    (tmp_path / "2026-09-01.manifest.json").write_text(
        '{\n "schema_version": 2,\n "date": "2026-09-01",\n "gaps": [{"after_ts": 1, "before_ts": 9, "gap_seconds": 8}]}'
    )
    row = jsonl.read_manifests(spark, str(tmp_path)).first()
    assert (row["service_date"], row["gaps"][0]["gap_seconds"], row["remote_verified"]) == (_day(1), 8, None)


def test_period_document(spark, tmp_path):
    (tmp_path / "t.json").write_text(
        '{"thresholds": {}, "segments": {"p1": {"k|3|08:15": {"median_speed_ms": 4.5, "n_samples": 2}}, "p2": {}}}'
    )
    rows = jsonl.read_period_document(spark, str(tmp_path / "t.json")).collect()
    assert [tuple(r) for r in rows] == [("p1", "k", 3, "08:15", 4.5, 2)]


BOM = "﻿"
MEMBERS = {
    "trips.txt": BOM + "route_id,service_id,trip_id,shape_id\nR1,A,T1,S1\nR1,A,T2,\n",
    "shapes.txt": "shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\nS1,42.1,23.1,2\nS1,42.0,23.0,10\nS1,42.2,23.2,1\n",
    "stops.txt": "stop_id,stop_lat,stop_lon\nX,42.0,23.0\n",
    "routes.txt": 'route_id,route_short_name,route_type\nR1,"1, express",3\n',
    "calendar_dates.txt": BOM + "service_id,date,exception_type\nA,20260901,1\nA,20260902,2\n",
    "feed_info.txt": "feed_version,feed_start_date\nv7,20260901\nv8,20260902\n",
}


def _zip(path, members, stamp=(2026, 9, 1, 0, 0, 0)):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(zipfile.ZipInfo(name, stamp), text)


ODD_MEMBERS = {
    "short": "b,a\n1,2\n3\n5,6,7\n",
    "same name": "b,b\n1,2\n",
    "blank lines": "a,b\n\n1,2\n\n3,4\n",
    "quoted": 'a,b\r\n"x, ""y""\r\nz", k \r\n,\r\n',
    "no newline": "b\n1\n2",
    "header only": "a,b\n",
    "empty": "",
    "no such column": "c,d\n1,2\n",
    "marked": BOM + "b,a\nü,\u00a0\n",
    "long field": "a,b\n1," + "y" * 1_500_000 + "\n2,z\n",
    "ragged late": "a,b\n" + "".join(f"{i},{i}\n" for i in range(200_000)) + "x\n" + "7,8\n" * 30_000,
}


def test_members_equal_rows_read_one_by_one(spark, tmp_path):
    for i, text in enumerate(ODD_MEMBERS.values()):
        _zip(tmp_path / f"gtfs_2026-09-{i + 1:02}.zip", {"m.txt": text})
    with zipfile.ZipFile(tmp_path / "gtfs_2026-10-01.zip", "w") as z:
        z.writestr("m.txt", b"a,b\n\xff,1\n")
    _zip(tmp_path / "gtfs_2026-10-02.zip", {"other.txt": "a,b\n1,2\n"})
    table = gtfs.member_table(gtfs.read_archives(spark, str(tmp_path)), "m.txt", ["b", "a", "z"])
    found = {}
    for r in table.orderBy("snapshot", "line_no").toArrow().to_pylist():
        found.setdefault(r["snapshot"], []).append((r["line_no"], r["b"], r["a"], r["z"]))
    csv.field_size_limit(2**31 - 1)
    for i, (case, text) in enumerate(ODD_MEMBERS.items()):
        rows = csv.DictReader(io.StringIO(text.removeprefix(BOM), newline=""))
        want = [(n, r.get("b"), r.get("a"), r.get("z")) for n, r in enumerate(rows)]
        assert found.get(f"gtfs_2026-09-{i + 1:02}.zip", []) == want, case
    assert found["gtfs_2026-10-01.zip"] == [(0, "1", "\ufffd", None)] and "gtfs_2026-10-02.zip" not in found


def test_feed_archives(spark, tmp_path):
    _zip(tmp_path / "gtfs_2026-09-01.zip", MEMBERS)
    _zip(tmp_path / "gtfs_2026-09-02.zip", {n: MEMBERS[n] for n in ("trips.txt", "stops.txt")})
    _zip(tmp_path / "gtfs_2026-09-03.zip", dict(reversed(MEMBERS.items())), (2026, 9, 3, 0, 0, 0))
    (tmp_path / "gtfs_2026-09-04.zip").write_bytes(b"not a zip")
    _zip(tmp_path / "gtfs_2026-09-05_copy.zip", MEMBERS)
    archives = gtfs.read_archives(spark, str(tmp_path))
    assert archives.count() == 4
    first = "snapshot = 'gtfs_2026-09-01.zip'"
    assert [tuple(r)[1:] for r in gtfs.trips(archives).filter(first).orderBy("trip_id").collect()] == [
        ("T1", "R1", "A", "S1"),
        ("T2", "R1", "A", ""),
    ]
    points = gtfs.shape_points(archives).filter(first).orderBy("shape_pt_sequence").collect()
    assert [r["shape_pt_lat"] for r in points] == [42.2, 42.1, 42.0]
    assert gtfs.routes(archives).filter(first).first()["route_short_name"] == "1, express"
    assert [r["service_id"] for r in gtfs.calendar_dates(archives).filter(first + " AND date = '20260901'").collect()] == ["A"]
    assert gtfs.stops(archives).filter(first).first()["stop_lat"] == 42.0
    info = {r["snapshot"][5:15]: (r["feed_version"], r["feed_end_date"]) for r in gtfs.feed_info(archives).collect()}
    assert info == {"2026-09-01": ("v7", None), "2026-09-02": (None, None), "2026-09-03": ("v7", None), "2026-09-04": (None, None)} or (
        info["2026-09-01"] == ("v7", None) and info["2026-09-02"] == (None, None)
    )
    members = gtfs.member_digests(archives)
    missing = {r["snapshot"][5:15]: r["missing"] for r in gtfs.usability(archives, members).collect()}
    assert missing["2026-09-01"] == [] and missing["2026-09-02"] == ["shapes.txt", "routes.txt"]
    assert len(missing["2026-09-04"]) == 4
    content = {r["snapshot"][5:15]: r["digest"] for r in digests.archive_digest(members, ["snapshot"]).collect()}
    # packing order and dates do not matter, content does
    assert content["2026-09-01"] == content["2026-09-03"] != content["2026-09-02"]
    pairs = sorted((n, hashlib.sha256(t.encode()).hexdigest()) for n, t in MEMBERS.items())
    want = hashlib.sha256("\n".join(f"{n}:{d}" for n, d in pairs).encode()).hexdigest()
    assert content["2026-09-01"] == want


def test_set_digest_is_blind_to_order_and_counts_repeats(spark):
    rows = [("x", "A"), ("x", "B"), ("y", "B"), ("y", "A"), ("z", "A"), ("z", "B"), ("z", "B")]
    out = {r["k"]: (r["digest"], r["items"]) for r in digests.set_digest(spark.createDataFrame(rows, "k string, p string"), ["k"], "p").collect()}
    parts = sorted(hashlib.sha256(p.encode()).hexdigest() for p in "AB")
    assert out["x"] == out["y"] == (hashlib.sha256("\n".join(parts).encode()).hexdigest(), 2)
    assert out["z"][0] != out["x"][0]


def test_twins(spark):
    text = b"line one\nline two\n" * 1000
    packed = io.BytesIO()
    with gzip.GzipFile(fileobj=packed, mode="wb") as z:
        z.write(text)
    plains = {"same": text, "cut": text[:777], "other": b"#" + text[1:777], "long": text + b"x"}
    rows = [(f"{n}.gz", packed.getvalue(), len(p)) for n, p in plains.items()]
    twins = digests.twin_digests(spark.createDataFrame(rows, "path string, content binary, plain_bytes bigint"))
    plain = spark.createDataFrame(
        [(f"{n}.gz", hashlib.sha256(p).hexdigest(), len(p)) for n, p in plains.items()],
        "path string, plain string, plain_bytes bigint",
    )
    verdicts = {r["path"][:-3]: r["verdict"] for r in reconcile.copy_verdicts(twins.join(plain, "path")).collect()}
    assert verdicts == {"same": "identical", "cut": "truncated", "other": "diverging", "long": "diverging"}


# runs as (alerts, accepted); None means refused
CAPTURES = {
    "reordered": ([["A", "B"], ["B", "A"]], [1, 0]),
    "changed": ([["A", "B"], ["A", "C"]], [1, 1]),
    "empty confirmed": ([["A"], [], []], [1, 0, 1]),
    "empty once": ([["A"], [], ["A"]], [1, 0, 0]),
    "refused": ([["A"], None, None], [1, 0, 0]),
    "refusal breaks confirmation": ([["A"], [], None, [], []], [1, 0, 0, 0, 1]),
    "there and back": ([["A"], ["B"], ["A"]], [1, 1, 1]),
    "first empty": ([[], []], [0, 1]),
}


def test_alert_capture(spark):
    runs, alerts = [], []
    for city, (answers, _) in CAPTURES.items():
        for i, answer in enumerate(answers):
            runs.append((city, i, answer is not None))
            alerts += [(city, i, a) for a in answer or []]
    logged = spark.createDataFrame(runs, "city string, ts bigint, accepted boolean")
    digest = digests.set_digest(spark.createDataFrame(alerts, "city string, ts bigint, alert string"), ["city", "ts"], "alert")
    joined = logged.join(digest, ["city", "ts"], "left").select(
        "city", "ts", "accepted", F.coalesce("items", F.lit(0)).alias("items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("digest"),
    )
    rows = capture.capture_alerts(joined, ["city"], ["ts"], F.floor(F.col("ts") / 2)).orderBy("city", "ts").collect()
    for city, (_, kept) in CAPTURES.items():
        assert [int(r["kept"]) for r in rows if r["city"] == city] == kept, city


def test_static_names(spark):
    rows = [("c", "2026-09-02 05:00:00", "a"), ("c", "2026-09-02 11:00:00", "b"), ("c", "2026-09-02 12:00:00", "b"),
            ("c", "2026-09-03 05:00:00", "a")]
    runs = spark.createDataFrame(rows, "city string, ts string, digest string").withColumn("local", F.to_timestamp("ts"))
    kept = capture.keep_changes(runs, ["city"], ["local"], F.to_date("local")).filter("kept")
    names = capture.name_snapshots(kept, ["city"], ["local"], F.col("local"))
    assert {r["snapshot"] for r in names.collect()} == {
        "gtfs_2026-09-02.zip", "gtfs_2026-09-02T1100.zip", "gtfs_2026-09-03.zip",
    }


def test_hour_compaction(spark):
    now = F.lit("2026-10-17 10:07:00").cast("timestamp")
    stamp = "tu_2026-10-17T{}Z.pb".format
    names = [stamp("090015"), stamp("095915"), stamp("100015"), "tu_2026-10-16T235945Z.pb", "notes.txt"]
    incoming = spark.createDataFrame([(n, f"sha-{n}") for n in names], "name string, sha256 string")
    closed = capture.closed_incoming(incoming, now)
    assert {(r["hour"], r["name"]) for r in closed.collect()} == {
        ("2026-10-17T09", names[0]), ("2026-10-17T09", names[1]), ("2026-10-16T23", names[3]),
    }
    archive = spark.createDataFrame(
        [("2026-10-17T09", names[0], f"sha-{names[0]}"), ("2026-10-17T09", names[1], "other bytes"),
         ("2026-10-17T08", stamp("080000"), "x")],
        "hour string, name string, sha256 string",
    )
    late = incoming.unionByName(spark.createDataFrame([(stamp("090100"), "late")], incoming.schema))
    compared = capture.compare_incoming(archive, capture.closed_incoming(late, now))
    fates = {r["name"]: r["fate"] for r in compared.collect()}
    assert fates == {names[0]: "same", names[1]: "conflict", names[3]: "new", stamp("090100"): "new"}
    merged = capture.merge_hours(archive, compared)
    assert sorted(r["name"] for r in merged.filter("hour = '2026-10-17T09'").collect()) == [names[0], stamp("090100"), names[1]]
    assert merged.filter("hour = '2026-10-17T08'").count() == 0  # untouched hours are not rewritten
    left = {r["name"] for r in capture.leftovers(late, compared).collect()}
    assert left == {names[1], names[2], names[4]}
    full = capture.hour_completeness(archive, 1200).collect()
    assert {(r["hour"][-2:], r["half_full"]) for r in full} == {("09", True), ("08", False)} or len(full) == 2


def test_entities(spark):
    schema = jsonl.ENTITY_SCHEMA
    lines = [
        '{"poll_ts": 10, "fetch_ok": true, "entity": [{"vehicle": {"vehicle": {"id": "V"}, "trip": {"trip_id": "T", '
        '"route_id": "R"}, "position": {"latitude": 42.12345678, "longitude": 23.5, "speed": 7.126}, "timestamp": 9}}, '
        '{"vehicle": {"position": {"latitude": 50.0, "longitude": 23.5}}}, {"vehicle": {"vehicle": {"id": "W"}}}, {}]}',
        '{"poll_ts": 55, "fetch_ok": false}',
    ]
    polls = spark.createDataFrame([(t,) for t in lines], "t string").select(F.from_json("t", schema).alias("p")).select("p.*")
    box = F.struct(F.lit(42.0).alias("lat_min"), F.lit(43.0).alias("lat_max"), F.lit(23.0).alias("lon_min"), F.lit(24.0).alias("lon_max"))
    rows = jsonl.records_inside(jsonl.vehicle_records(polls), box).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["lat"], row["speed_ms"], row["vehicle_ts"], row["bearing"], row["schedule_relationship"]) == (42.123457, 7.13, 9, None, None)
    audit = {r["snapshot_ts"]: tuple(r)[1:] for r in jsonl.poll_audit(polls, box).collect()}
    assert audit == {10: (True, 1, 3, 2, 1), 55: (False, 0, 0, 0, 0)}
