import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fleetgrain.functions import clock
from fleetgrain.operators import quality
from fleetgrain.sources import profiles

DAY = dt.date(2026, 9, 1)
POLL = (
    "service_date date, snapshot_ts bigint, fetch_ok boolean, vehicle_count bigint, entities_total bigint, "
    "vehicles_with_position bigint, dropped_out_of_bbox bigint"
)
WINDOW = "service_date date, start_ts bigint, end_ts bigint, day_in_progress boolean"


def _times(spark, stamps):
    return spark.createDataFrame([(DAY, t) for t in stamps], "service_date date, snapshot_ts bigint")


def _judge(spark, stamps, start, end, in_progress=False):
    times = _times(spark, stamps)
    window = spark.createDataFrame([(DAY, start, end, in_progress)], WINDOW)
    gaps = quality.poll_gaps(times, window, 45).orderBy("after_ts").collect()
    cover = quality.coverage(times, window, 45).first()
    observed = quality.observed_interval(times).first()
    return [g["gap_seconds"] for g in gaps], cover, observed and observed["observed_interval_sec"]


FIVE = [1000 + 45 * i for i in range(5)]


@pytest.mark.parametrize(
    "stamps, start, end, running, gaps, coverage, lag, observed",
    [
        (FIVE, 1000, 1225, False, [], 100.0, None, 45.0),
        ([1000, 1045, 1090, 1690, 1735], 1000, 1780, False, [600], None, None, 45.0),
        (FIVE, 1000, FIVE[-1] + 1800, True, [], 100.0, 1800, 45.0),
        (FIVE, 1000, FIVE[-1] + 1800, False, [1800], None, None, 45.0),
        ([], 0, 86400, False, [86400], 0.0, None, None),
        ([43200], 0, 86400, False, [43200, 43200], round(100 / 1920, 2), None, None),
        (list(range(0, 86400, 90)), 0, 86400, False, [], 50.0, None, 90.0),
        ([1000, 1000, 1045], 1000, 1090, False, [], 150.0, None, 22.5),
    ],
)
def test_gaps_and_coverage(spark, stamps, start, end, running, gaps, coverage, lag, observed):
    got_gaps, cover, got_observed = _judge(spark, stamps, start, end, running)
    assert got_gaps == gaps
    if coverage is not None:
        assert cover["coverage_pct"] == coverage
    else:
        assert cover["coverage_pct"] < 100
    assert cover["local_lag_sec"] == lag
    assert got_observed == observed


def test_poll_outcomes(spark):
    polls = spark.createDataFrame(
        [(DAY, 1, True, 2, 5, 4, 3), (DAY, 46, True, 0, 0, 0, 0), (DAY, 91, False, 0, 0, 0, 0)], POLL
    )
    row = quality.poll_outcomes(polls).first()
    assert (row["polls_logged"], row["successful_polls"], row["empty_polls"], row["fetch_error_polls"]) == (3, 2, 1, 1)
    assert row["dropped_out_of_bbox_pct"] == 75.0
    none = quality.poll_outcomes(polls.filter("snapshot_ts = 91")).first()
    assert none["dropped_out_of_bbox_pct"] is None


def test_late_heartbeat_takes_the_datas_stamps(spark):
    beats = spark.createDataFrame([(DAY, 10_000 + 45 * i, True, 1, 1, 1, 0) for i in range(3)], POLL)
    data = _times(spark, [0, 0, 45, 10_000])
    times = quality.poll_times(beats, data)
    assert {r["snapshot_ts"] for r in times.collect()} == {0, 45, 10_000, 10_045, 10_090}
    assert {r["heartbeat_partial"] for r in times.collect()} == {True}
    window = spark.createDataFrame([(DAY, 0, 10_500, False)], WINDOW)
    gaps = quality.poll_gaps(times, window, 45).orderBy("after_ts").collect()
    assert [g["gap_seconds"] for g in gaps] == [9955, 410]


def test_without_heartbeat_distinct_stamps_count(spark):
    times = quality.poll_times(spark.createDataFrame([], POLL), _times(spark, [0, 0, 45]))
    rows = times.collect()
    assert len(rows) == 2 and {r["heartbeat_partial"] for r in rows} == {None}


def test_whole_heartbeat_counts_repeats(spark):
    beats = spark.createDataFrame([(DAY, t, True, 1, 1, 1, 0) for t in (100, 100, 145)], POLL)
    times = quality.poll_times(beats, _times(spark, [100, 120]))
    assert times.agg(F.sum("polls")).first()[0] == 3


def test_day_window_of_a_25_hour_day(spark):
    days = spark.createDataFrame([(dt.date(2026, 10, 25),), (dt.date(2026, 3, 29),)], "service_date date")
    rows = quality.day_windows(days, "Europe/Athens", F.lit(1 << 40)).orderBy("service_date").collect()
    assert [r["end_ts"] - r["start_ts"] for r in rows] == [82800, 90000]
    assert not any(r["day_in_progress"] for r in rows)
    noon = clock.day_start(F.lit("2026-10-25").cast("date"), "Europe/Athens")
    cut = quality.day_windows(days.filter("service_date = '2026-10-25'"), "Europe/Athens", noon + 40_000).first()
    assert cut["day_in_progress"] and cut["end_ts"] - cut["start_ts"] == 40_000


def test_extra_poll_covers_more_than_the_day(spark):
    stamps = [i * 45 for i in range(1920)] + [86399]
    _, cover, _ = _judge(spark, stamps, 0, 86400)
    assert (cover["polls"], cover["expected_polls"], cover["coverage_pct"]) == (1921, 1920.0, 100.05)


def test_day_manifest_has_everything(spark):
    start = clock.day_start(F.lit(DAY), "UTC")
    t0 = spark.range(1).select(start.alias("t")).first()["t"]
    beats = spark.createDataFrame([(DAY, t0 + 45 * i, True, 1, 1, 1, 0) for i in range(10)], POLL)
    data = _times(spark, [t0 + 45 * i for i in range(10) for _ in range(3)])
    digests = spark.createDataFrame([(DAY, "aa", 9, "bb")], "service_date date, data_sha256 string, data_size_bytes bigint, polls_sha256 string")
    row = quality.day_manifests(data, beats, digests, "UTC", F.lit(t0 + 500), 45).first()
    assert (row["total_vehicle_records"], row["polls_logged"], row["gap_count"]) == (30, 10, 0)
    assert row["day_in_progress"] and row["coverage_pct"] == 100.0 and row["local_lag_sec"] == 95
    assert row["data_sha256"] == "aa" and row["heartbeat_partial"] is False


def test_city_violations(spark):
    schema = (
        "slug string, lat_min double, lat_max double, lon_min double, lon_max double, speed_field_unit string, "
        "timezone string, poll_interval_sec int, positions_feed string, static_feed string, licence string"
    )
    good = ("good", 1.0, 2.0, 1.0, 2.0, "kmh", "UTC", 45, "u", "u", "CC0")
    bad = ("bad", 2.0, 2.0, 1.0, None, "mph", "", 0, "", None, "")
    rows = quality.city_violations(spark.createDataFrame([good, bad], schema)).collect()
    assert {r["slug"] for r in rows} == {"bad"} and len(rows) == 8


GOOD = {
    "slug": "good", "name": "G", "timezone": "Europe/Athens", "poll_interval_sec": 30, "speed_field_unit": "ms",
    "bbox": {"lat_min": 1, "lat_max": 2, "lon_min": 3.5, "lon_max": 4},
    "feeds": {"vehicle_positions": "u", "static": "v"},
    "attribution": {"source_name": "s", "licence": "CC0", "feed_licences": {"vehicle_positions": "a", "static": "b"}},
    "auth": None,
}


def _problems(spark, profile):
    text = profile if profile is None or isinstance(profile, str) else json.dumps(profile)
    frame = spark.createDataFrame([("good", text)], "slug string, text string")
    return sorted(r["problem"] for r in profiles.profile_violations(frame).collect())


def test_profiles_name_every_broken_rule(spark):
    assert _problems(spark, GOOD) == []
    for text in (None, "", "{", "[]", "3", "null"):
        assert _problems(spark, text) == ["not a JSON object"]
    assert _problems(spark, {**GOOD, "slug": "bad"}) == ["declares another slug than its file name"]
    assert _problems(spark, {k: v for k, v in GOOD.items() if k not in ("feeds", "bbox")}) == [
        "missing required key bbox",
        "missing required key feeds",
    ]
    assert _problems(spark, {**GOOD, "bbox": {"lat_min": 2, "lat_max": 2, "lon_min": "x"}}) == [
        "bbox has lat_min at or above lat_max",
        "bbox is missing lon_max",
        "bbox is missing lon_min",
    ]
    assert _problems(spark, {**GOOD, "feeds": {"static": ""}}) == ["no static feed", "no vehicle_positions feed"]
    assert _problems(spark, {**GOOD, "attribution": {"licence": "x", "feed_licences": []}}) == [
        "attribution has no feed_licences map",
        "attribution is missing source_name",
    ]
    licences = {"source_name": "s", "licence": "x", "feed_licences": {"static": "CC0"}}
    assert _problems(spark, {**GOOD, "attribution": licences}) == ["no licence stated for the vehicle_positions feed"]
    assert _problems(spark, {**GOOD, "auth": {}, "speed_field_unit": None}) == [
        "auth names no environment variable",
        "unknown speed field unit",
    ]


def test_profile_files_become_parameters(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps(GOOD, indent=1))
    (tmp_path / "torn.json").write_text('{"slug": "torn"')
    read = profiles.read_profiles(spark, str(tmp_path))
    found = profiles.city(read, "good")
    assert (found.lat_min, found.lon_min, found.poll_interval_sec) == (1.0, 3.5, 30)
    assert (found.walk_params().timezone, found.walk_params().speed_field_unit) == ("Europe/Athens", "ms")
    with pytest.raises(ValueError, match="not a JSON object"):
        profiles.city(read, "torn")
    with pytest.raises(ValueError, match="no profile"):
        profiles.city(read, "absent")
    said = {r["slug"]: r["attribution"] for r in profiles.attributions(read).collect()}
    assert json.loads(said["good"]) == GOOD["attribution"] and said["torn"] is None
