import pytest

from fleetgrain.operators import profile
from fleetgrain.operators.profile import Comparison

EARLY = {
    "a": {"08:00": 10.0, "12:00": 14.0, "00:00": 30.0},
    "b": {"08:00": 20.0, "12:00": 16.0},
    "c": {"08:00": 12.0},
    "d": {"08:00": 8.0, "12:00": 0.0},
}
LATE = {"a": {"08:00": 8.0, "12:00": 14.0}, "b": {"08:00": 20.0, "12:00": 16.0}, "e": {"08:00": 5.0, "12:00": 5.0}}
SCHEMA = "period_key string, shape_key string, segment_index int, timeslot string, kmh double"


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        (period, shape, 0, slot, kmh)
        for period, segments in (("early", EARLY), ("late", LATE))
        for shape, speeds in segments.items()
        for slot, kmh in speeds.items()
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_paired(table):
    comparisons = (Comparison("x", "08:00", "12:00"), Comparison("none", "08:00", "23:45"))
    rows = profile.paired(table.filter("period_key = 'early'"), comparisons).collect()
    assert [r["label"] for r in rows] == ["x"]  # nothing carries both sides of the other
    row = rows[0]
    assert (row["n"], row["zeroes"], row["median_diff"]) == (2, 1, 0.0)
    assert (row["iqr_low"], row["iqr_high"], row["share_a_slower"]) == (-4.0, 4.0, 0.5)


def test_against(table):
    rows = {r["label"]: r for r in profile.against(table, "late", "early").collect()}
    row = rows["08:00"]
    assert (row["n"], row["median_diff"], row["share_a_slower"]) == (2, -1.0, 0.5)
    counts = profile.common_segments(table, "late", "early").first()
    assert (counts["later_segments"], counts["earlier_segments"], counts["in_both"]) == (3, 4, 2)


def test_window_median(spark):
    rows = [("p", "k", 0, s, v) for s, v in (("07:00", 10.0), ("12:00", 20.0), ("23:00", 99.0))]
    out = profile.window_medians(
        spark.createDataFrame(rows, SCHEMA), {"day": ("07:00", "18:45"), "none": ("01:00", "03:00")}
    ).first()
    assert (out["day"], out["none"]) == (15.0, None)


def test_persistence(table):
    rows = {r["cut_kmh"]: r for r in profile.persistence(table.filter("period_key = 'early'"), (15.0, 18.0)).collect()}
    assert (rows[15.0]["population"], rows[15.0]["slow_at_a"], rows[15.0]["still_slow"], rows[15.0]["share"]) == (2, 1, 1, 1.0)
    assert rows[18.0]["slow_at_a"] == 1


def test_profile_extremes_and_populations(table):
    early = table.filter("period_key = 'early'")
    prof = profile.network_profile(early)
    rows = {r["timeslot"]: (r["median_kmh"], r["segments"]) for r in prof.collect()}
    assert rows["08:00"] == (11.0, 4) and rows["00:00"] == (30.0, 1)
    core = profile.core_extremes(prof).first()
    assert (core["lowest_slot"], core["highest_slot"], core["range_kmh"]) == ("08:00", "12:00", 3.0)
    people = profile.populations(early).first()
    assert (people["day_segments"], people["night_segments"]) == (4, 1)


def test_core_ties_go_to_the_earlier_slot(spark):
    prof = spark.createDataFrame(
        [("p", s, k, 1) for s, k in (("08:00", 9.0), ("09:00", 9.0), ("10:00", 12.0), ("11:00", 12.0), ("20:00", 1.0))],
        "period_key string, timeslot string, median_kmh double, segments bigint",
    )
    row = profile.core_extremes(prof).first()
    assert (row["lowest_slot"], row["highest_slot"]) == ("08:00", "10:00")


def test_edge_runs(spark):
    prof = spark.createDataFrame(
        [("p", f"0{i}:00", 10.0, n) for i, n in enumerate((2000, 1500, 999, 1000, 1000, 1000))],
        "period_key string, timeslot string, median_kmh double, segments bigint",
    )
    runs = profile.edge_runs(prof).orderBy("run_no").collect()
    assert [(r["solid"], r["from_slot"], r["to_slot"], r["edges"]) for r in runs] == [
        (True, "00:00", "01:00", 1),
        (False, "01:00", "03:00", 2),
        (True, "03:00", "05:00", 2),
    ]
