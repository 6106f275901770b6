"""A small archive from files to bundles, through the command line's own functions."""

import datetime as dt
import gzip
import json
import os
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetgrain import __main__ as cli
from fleetgrain.params import WalkParams
from fleetgrain.plans import export, pipeline
from tests.helpers import HOP_M

DAYS = [dt.date(2026, 9, d) for d in (1, 2, 5)]  # Tuesday, Wednesday, Saturday
NOON = {d: int(dt.datetime(d.year, d.month, d.day, 12, tzinfo=dt.timezone.utc).timestamp()) for d in DAYS}


def _feed(path, trips):
    lines = ["shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence"]
    lines += [f"S1,{0.001 * i:.3f},0.0,{i}" for i in range(11)]
    dates = ["service_id,date,exception_type"] + [f"A,{d:%Y%m%d},1" for d in DAYS]
    members = {
        "trips.txt": "\n".join(["trip_id,route_id,service_id,shape_id", *[f"{t},R1,A,{s}" for t, s in trips]]),
        "shapes.txt": "\n".join(lines),
        "calendar_dates.txt": "\n".join(dates),
        "routes.txt": "route_id,route_short_name,route_type\nR1,1,3",
        "stops.txt": "stop_id,stop_lat,stop_lon\nX,0,0",
    }
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text + "\n")


def _fix(ts, vehicle, trip, at):
    return {"snapshot_ts": ts, "vehicle_id": vehicle, "trip_id": trip, "lat": 0.001 * at, "lon": 0.0, "speed_ms": 9.0}


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    (root / "static").mkdir()
    _feed(root / "static" / "gtfs_2026-09-01.zip", [("T1", "S1"), ("T4", "S9")])
    _feed(root / "static" / "gtfs_2026-09-02.zip", [("T1", "S1"), ("T2", "S1")])
    for day in DAYS:
        t = NOON[day]
        records = [_fix(t + 45 * i, "V1", "T1", 2 + i) for i in range(5)]
        records += [_fix(t + 45 * i, "V2", "T2", 2 + i) for i in range(3)]
        records += [_fix(t, "V3", "T4", 1), _fix(t, "V4", "T9", 1), {**_fix(t, "V5", "T1", 1), "vehicle_id": None}]
        text = "".join(json.dumps(r) + "\n" for r in records) + '{"torn'
        if day == DAYS[1]:
            with gzip.open(root / f"{day}.jsonl.gz", "wt") as out:
                out.write(text)
        else:
            (root / f"{day}.jsonl").write_text(text)
        beats = [{"snapshot_ts": t + 45 * i, "fetch_ok": True, "vehicle_count": 2} for i in range(5)]
        (root / f"{day}.polls.jsonl").write_text("".join(json.dumps(b) + "\n" for b in beats))
    return root


@pytest.fixture(scope="module")
def run(spark, archive, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    today = F.lit("2026-09-20").cast("date")
    made = pipeline.run_speeds(
        spark, str(archive), str(archive / "static"), out, "c", WalkParams(timezone="UTC"), today=today
    )
    return out, made


def test_day_records(run):
    days = {r["service_date"]: r for r in run[1].days.collect()}
    first, second, saturday, total = (days[d] for d in (*DAYS, None))
    assert (first["records"], first["samples"], first["trip_not_in_static"], first["shape_not_found"]) == (11, 6, 2, 1)
    assert (first["trips_from_next_feed"], first["records_from_next_feed"]) == (1, 3)
    assert (second["snapshot"], second["trips_from_next_feed"], second["samples"]) == ("gtfs_2026-09-02.zip", 0, 6)
    assert saturday["excluded_from_median"] == "weekend" and saturday["period_key"] is None
    assert total["records"] == 33
    assert total["records"] == sum(total[c] for c in ("walks", "pairs", "trip_not_in_static", "shape_not_found"))


def test_bins_and_summary(run):
    _, made = run
    rows = made.bins.collect()
    # both weekdays run two trips of one route, so they share a period
    assert len({r["period_key"] for r in rows}) == 1
    assert sum(r["n_samples"] for r in rows) == 12
    assert {r["median_speed_ms"] for r in rows} == {round(HOP_M / 45, 3)}
    summary = made.summary.first()
    assert (summary["n_compared"], summary["multi_id_geometries"]) == (18, 0)
    assert summary["segment_count"] == summary["distinct_segment_count"] == len(rows)


def test_requested_day_keeps_the_plans_keys(spark, archive, run, tmp_path):
    one = pipeline.run_speeds(
        spark, str(archive), str(archive / "static"), str(tmp_path), "c", WalkParams(timezone="UTC"),
        today=F.lit("2026-09-20").cast("date"), dates=["2026-09-02"],
    )
    assert {r["period_key"] for r in one.bins.collect()} == {r["period_key"] for r in run[1].bins.collect()}
    assert one.samples.count() == 6


def _rerun(spark, archive, out, dates, static="static"):
    today = F.lit("2026-09-20").cast("date")
    return pipeline.run_speeds(
        spark, str(archive), str(archive / static), str(out), "c", WalkParams(timezone="UTC"), today=today, dates=dates
    )


def test_a_rerun_of_one_day_counts_that_day_only(spark, archive, tmp_path):
    _rerun(spark, archive, tmp_path, ["2026-09-01"])
    days = {r["service_date"]: r for r in _rerun(spark, archive, tmp_path, ["2026-09-02"]).days.collect()}
    assert days.keys() == {DAYS[1], None}
    assert days[None]["records"] == days[DAYS[1]]["records"] == 11 and days[DAYS[1]]["snapshot"] == "gtfs_2026-09-02.zip"
    # the other day's samples are still there
    assert {r["service_date"] for r in spark.read.parquet(f"{tmp_path}/samples").select("service_date").collect()} == set(DAYS[:2])


def test_a_run_without_weekdays_ends_with_an_empty_median(spark, archive, tmp_path):
    run = _rerun(spark, archive, tmp_path, ["2026-09-05"])
    assert run.samples.count() == 6 and run.bins.count() == 0
    assert {r["service_date"] for r in run.days.collect()} == {DAYS[2], None}
    assert run.summary.first()["segment_count"] == 0


def test_a_broken_archive_is_named_and_not_used(spark, archive, tmp_path):
    folder = archive / "static_broken"
    folder.mkdir(exist_ok=True)
    _feed(folder / "gtfs_2026-09-01.zip", [("T1", "S1"), ("T2", "S1")])
    whole = (folder / "gtfs_2026-09-01.zip").read_bytes()
    (folder / "gtfs_2026-09-02.zip").write_bytes(whole[: len(whole) // 2])
    (folder / "gtfs_2026-99-99.zip").write_bytes(whole)
    run = _rerun(spark, archive, tmp_path, [], "static_broken")
    assert [(r["snapshot"], len(r["missing"])) for r in run.unusable.collect()] == [("gtfs_2026-09-02.zip", 4)]
    days = {r["service_date"]: r for r in run.days.collect()}
    assert days[DAYS[1]]["snapshot"] == "gtfs_2026-09-01.zip" and days[DAYS[1]]["samples"] == 6


def test_fixes_without_coordinates_are_counted(spark, archive, tmp_path):
    root = tmp_path / "data"
    root.mkdir()
    t = NOON[DAYS[0]]
    records = [_fix(t + 45 * i, "V1", "T1", 2 + i) for i in range(4)]
    records[1] = {**records[1], "lat": None}
    (root / f"{DAYS[0]}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records))
    (root / "2026-99-99.jsonl").write_text("")
    today = F.lit("2026-09-20").cast("date")
    run = pipeline.run_speeds(
        spark, str(root), str(archive / "static"), str(tmp_path / "out"), "c", WalkParams(timezone="UTC"), today=today
    )
    row = run.days.filter("service_date IS NULL").first()
    assert (row["records"], row["position_unusable"], row["samples"]) == (4, 1, 2)


def test_export_manifests_and_profile(spark, archive, run, capsys):
    out, made = run
    parse = cli._parser().parse_args
    cli.run_manifests(spark, parse(["manifests", str(archive), out]))
    manifests = {r["service_date"]: r for r in spark.read.parquet(f"{out}/manifests").collect()}
    assert manifests[DAYS[0]]["polls_logged"] == 5 and len(manifests[DAYS[0]]["data_sha256"]) == 64
    assert manifests[DAYS[0]]["gap_count"] == 2 and manifests[DAYS[0]]["coverage_pct"] == 0.26
    # a second run finds every record current; a newer file makes its day stale again
    before = {d: r["manifest_mtime"] for d, r in manifests.items()}
    cli.run_manifests(spark, parse(["manifests", str(archive), out]))
    later = max(before.values()) + 100
    os.utime(archive / f"{DAYS[2]}.jsonl", (later, later))
    (archive / f"{DAYS[1]}.jsonl.gz").with_name("notes.txt").write_text("not a day file")
    cli.run_manifests(spark, parse(["manifests", str(archive), out]))
    after = {r["service_date"]: r["manifest_mtime"] for r in spark.read.parquet(f"{out}/manifests").collect()}
    assert after.keys() == before.keys()
    assert {d for d in DAYS if after[d] != before[d]} == {DAYS[2]}
    attribution = {"source_name": "s", "licence": "CC0", "feed_licences": {"vehicle_positions": "a", "static": "b"}}
    profile = {
        "slug": "c", "name": "C", "timezone": "UTC", "poll_interval_sec": 45, "speed_field_unit": "kmh",
        "bbox": {"lat_min": 0, "lat_max": 1, "lon_min": 0, "lon_max": 1},
        "feeds": {"vehicle_positions": "u", "static": "v"}, "attribution": attribution,
    }
    folder = Path(out).parent / "profiles"
    folder.mkdir(exist_ok=True)
    (folder / "c.json").write_text(json.dumps({**profile, "timezone": "UTC", "feeds": {}}))
    job = ["export", str(archive / "static"), out, "--profile", str(folder / "c.json")]
    with pytest.raises(ValueError, match="breaks a rule"):
        cli.run_export(spark, parse(job))
    (folder / "c.json").write_text(json.dumps(profile))
    cli.run_export(spark, parse(job))
    records = spark.read.parquet(f"{out}/typical/bundles").first()
    assert records["days_in_median"] == DAYS[:2]
    assert set(records["incomplete_days"]) == {str(d) for d in DAYS[:2]}
    assert records["segments_after"] >= 2 and records["segment_length_m"] == 200.0
    assert (records["mode"], records["schedule_period"]["period_key"]) == ("typical_weekday", records["bundle"])
    assert json.loads(records["attribution"]) == attribution and records["timeslot_count"] == len(records["timeslots"])
    document = spark.read.json(f"{out}/typical/geometry").first()
    assert set(document["shape_idx"]) <= set(range(len(document["shape_keys"]))) and document["shape_route_type"] == [3]
    whole = spark.read.parquet(f"{out}/period_index").first()
    assert (whole["current_period"], whole["period_count"]) == (records["bundle"], 1)
    assert {r["date"] for r in whole["days_excluded_from_median"]} == set(DAYS[2:])
    assert spark.read.parquet(f"{out}/unloaded_feeds").count() == 0
    segments = spark.read.parquet(f"{out}/typical/segments").collect()
    assert {tuple(s["route_ids"]) for s in segments} == {("R1",)} and {s["route_type"] for s in segments} == {3}
    by_day = {r["bundle"]: r for r in spark.read.parquet(f"{out}/by_day/bundles").collect()}
    assert by_day.keys() == {str(d) for d in DAYS}
    assert {(r["mode"], r["schedule_period"]) for r in by_day.values()} == {("day", None)}
    index = export.bundle_index(spark.read.parquet(f"{out}/typical/bundles"), spark.read.parquet(f"{out}/periods"))
    assert [r["is_current"] for r in index.collect()] == [True]
    root = {(r["kind"], r["is_current"]) for r in spark.read.parquet(f"{out}/index").collect()}
    assert root == {("day", False), ("typical_weekday", True)}
    cli.run_profile(spark, parse(["profile", out]))
    assert "12:00" in {r["timeslot"] for r in spark.read.parquet(f"{out}/profile/slots").collect()}
    assert f"{out}/profile/paired" in capsys.readouterr().out


def test_day_records_close_the_loop(spark, archive, tmp_path):
    """Records of all listed days, an empty one too, then the origin's checksums, then the gate."""
    data, out = tmp_path / "data", str(tmp_path / "out")
    data.mkdir()
    for name in sorted(os.listdir(archive)):
        if ".jsonl" in name:
            (data / name).write_bytes((archive / name).read_bytes())
    (data / "2026-09-03.jsonl").write_text("")
    (data / "2026-09-04.jsonl").write_text("")
    (data / "2026-09-04.polls.jsonl").write_text('{"snapshot_ts": 1788480000, "fetch_ok": true, "vehicle_count": 0}\n{"torn')
    (data / "2026-99-99.jsonl").write_text("stray")
    parse = cli._parser().parse_args
    cli.run_manifests(spark, parse(["manifests", str(data), out]))
    made = {str(r["service_date"]): r for r in spark.read.parquet(f"{out}/manifests").collect()}
    assert sorted(made) == [f"2026-09-0{d}" for d in range(1, 6)]
    first, plain, empty, beats = (made[f"2026-09-0{d}"] for d in (2, 1, 3, 4))
    assert (first["data_file"], first["compressed"], plain["compressed"]) == ("2026-09-02.jsonl", True, False)
    assert (first["data_malformed_lines"], first["polls_malformed_lines"], first["nominal_interval_sec"]) == (1, 0, 45)
    assert (empty["total_vehicle_records"], empty["heartbeat_available"], empty["polls_file"]) == (0, False, None)
    assert (empty["coverage_pct"], empty["gap_count"], empty["day_in_progress"]) == (0.0, 1, False)
    assert (beats["polls_logged"], beats["polls_malformed_lines"], beats["heartbeat_available"]) == (1, 1, True)
    assert first["generated_at"].endswith("Z")
    # nothing is stale now, not even the empty day
    before = {k: r["manifest_mtime"] for k, r in made.items()}
    cli.run_manifests(spark, parse(["manifests", str(data), out]))
    assert before == {str(r["service_date"]): r["manifest_mtime"] for r in spark.read.parquet(f"{out}/manifests").collect()}

    sums = tmp_path / "sums.txt"
    lines = [f"{r[f'{k}_sha256']}  {r[f'{k}_file']}" for r in made.values() for k in ("data", "polls") if r[f"{k}_file"]]
    sums.write_text("\n".join(line for line in lines if "2026-09-05" not in line).replace(plain["data_sha256"], "0" * 64))
    cli.run_verify(spark, parse(["verify", str(sums), out]))
    checked = {str(r["service_date"]): r for r in spark.read.parquet(f"{out}/manifests").collect()}
    assert {d[-1]: r["remote_verified"] for d, r in checked.items()} == {"1": False, "2": True, "3": True, "4": True, "5": None}
    assert checked["2026-09-01"]["remote_verify_note"] == "data_sha256" and checked["2026-09-02"]["remote_verified_at"]

    cli.run_package_check(spark, parse(["package-check", str(data), "2026-09-02", "2026-09-04", out]))
    left = {r["name"]: r["reason"] for r in spark.read.parquet(f"{out}/left_behind").collect()}
    assert left["2026-09-01.jsonl"] == "out_of_range" and left["2026-99-99.jsonl"] == "unrecognised"
    (data / "2026-09-03.jsonl").write_text("changed")
    with pytest.raises(ValueError, match="can't be packaged"):
        cli.run_package_check(spark, parse(["package-check", str(data), "2026-09-02", "2026-09-06", out]))
    found = {(r["item"], r["reason"]) for r in spark.read.parquet(f"{out}/package_check").collect()}
    assert found == {("2026-09-03.jsonl", "hash_mismatch"), ("2026-09-06", "missing")}
    with pytest.raises(ValueError, match="backwards"):
        cli.run_package_check(spark, parse(["package-check", str(data), "2026-09-06", "2026-09-02", out]))
