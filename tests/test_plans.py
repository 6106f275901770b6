import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetgrain.plans import calendar, periods, snapshots

# Counts of a day by name, R1/R2 unless said; the limit at BASE is 75 trips.
COUNTS = {
    "BASE": {"R1": 10000, "R2": 5000},
    "PLUS3": {"R1": 10002, "R2": 5001},
    "ENDED": {"R1": 9852, "R2": 5000},
    "D1": {"R1": 10070, "R2": 5000},
    "D2": {"R1": 10140, "R2": 5000},
    "VARIANT": {"R1": 10000, "R2": 5000, "R3": 100},
    "RET1": {"R1": 10037, "R2": 5000},
    "RET2": {"R1": 10000, "R2": 5000, "R3": 60},
    "AUTUMN": {"R1": 9800, "R2": 5000},
    "NEWER": {"R1": 10100, "R2": 5000},
    "FAR": {"R1": 9000, "R2": 5000},
    "HOLIDAY": {"R1": 7000, "R2": 3149},
    "WEEKEND": {"R1": 6000, "R2": 3800},
    "CLOSER": {"R1": 10030, "R2": 5000},
    "TIE": {"R1": 10050, "R2": 5000},
    "EMPTY": {},
}
MONDAY = dt.date(2026, 9, 7)

# sequence -> (index of the day whose key each day carries or the exclusion, churn per day)
CASES = {
    "BASE PLUS3": ([0, 0], [0, 3]),
    "BASE ENDED": ([0, 1], [0, 0]),
    "BASE D1 D2": ([0, 0, 2], [0, 70, 0]),
    "BASE BASE VARIANT VARIANT RET1 RET2": ([0, 0, 2, 2, 0, 0], [0, 0, 0, 0, 37, 60]),
    "BASE VARIANT AUTUMN AUTUMN": ([0, 1, 2, 2], [0, 0, 0, 0]),
    "BASE NEWER FAR CLOSER": ([0, 1, 2, 0], [0, 0, 0, 30]),
    "BASE NEWER FAR D1": ([0, 1, 2, 1], [0, 0, 0, 30]),
    "BASE NEWER FAR TIE": ([0, 1, 2, 1], [0, 0, 0, 50]),
    "BASE BASE HOLIDAY BASE": ([0, 0, "reduced_service", 0], [0, 0, None, 0]),
    "EMPTY EMPTY EMPTY EMPTY EMPTY EMPTY BASE BASE BASE BASE BASE HOLIDAY": (
        ["no_calendar_rows"] * 6 + [6] * 5 + ["reduced_service"],
        [None] * 6 + [0] * 5 + [None],
    ),
    "BASE EMPTY": ([0, "no_calendar_rows"], [0, None]),
}


def _days(spark, cases):
    rows = []
    for city, names in cases.items():
        for i, name in enumerate(names.split()):
            day = MONDAY + dt.timedelta(days=i // 5 * 7 + i % 5)
            counts = COUNTS[name]
            rows.append((city, day, f"sig_{i}", counts, sum(counts.values())))
    schema = "city string, service_date date, signature_key string, counts map<string,bigint>, trip_count bigint"
    return spark.createDataFrame(rows, schema)


def test_period_cases(spark):
    days = _days(spark, {name: name for name in CASES})
    rows = periods.assign_periods(days, ["city"]).orderBy("city", "service_date").collect()
    for name, (keys, churn) in CASES.items():
        mine = [r for r in rows if r["city"] == name]
        got = [r["excluded_from_median"] or int(r["period_key"].split("_")[1]) for r in mine]
        assert got == keys, name
        assert [r["churn_vs_reference"] for r in mine] == churn, name


def test_period_lists_days_that_are_not_contiguous_and_current_period(spark):
    name = "BASE BASE VARIANT VARIANT RET1 RET2"
    assigned = periods.assign_periods(_days(spark, {name: name}), ["city"])
    counts = spark.createDataFrame([("sig_0", 9)], "period_key string, bin_count bigint")
    summary = periods.period_summary(assigned, counts, ["city"])
    by_key = {r["period_key"]: r for r in summary.collect()}
    assert len(by_key["sig_0"]["days_in_median"]) == 4
    assert by_key["sig_0"]["max_churn_vs_reference"] == 60
    assert (by_key["sig_0"]["bin_count"], by_key["sig_2"]["bin_count"]) == (9, 0)
    assert (by_key["sig_2"]["route_count"], by_key["sig_2"]["trip_count"]) == (3, 15100)
    assert periods.current_period(summary, ["city"]).first()["current_period"] == "sig_0"


def test_weekend_has_no_period(spark):
    saturday = MONDAY + dt.timedelta(days=5)
    days = _days(spark, {"c": "BASE"}).unionByName(
        spark.createDataFrame([("c", saturday, "w", COUNTS["WEEKEND"], 9800)], _days(spark, {"c": "BASE"}).schema)
    )
    last = periods.assign_periods(days, ["city"]).orderBy(F.desc("service_date")).first()
    assert (last["excluded_from_median"], last["period_key"]) == ("weekend", None)


def test_current_period_tie_and_none(spark):
    schema = "period_key string, days_in_median array<string>"
    two = spark.createDataFrame([("a", ["2026-09-01", "2026-09-02"]), ("b", ["2026-09-03", "2026-09-04"]), ("c", [])], schema)
    assert periods.current_period(two, []).first()["current_period"] == "b"
    assert periods.current_period(two.filter("period_key = 'c'"), []).first()["current_period"] is None


FILES = ["gtfs_2026-09-10.zip", "gtfs_2026-09-10T1100.zip", "gtfs_2026-09-11.zip"]


def _catalogue(spark, names):
    files = spark.createDataFrame([("c", n) for n in names], "city string, name string")
    return snapshots.catalogue(files, ["city"])


def test_catalogue_orders_by_name_and_ignores_foreign_files(spark):
    rows = _catalogue(spark, [FILES[2], "gtfs_2026-09-10.zip.part", ".DS_Store", *FILES[:2]]).orderBy("seq").collect()
    assert [r["snapshot"] for r in rows] == FILES
    assert [r["next_snapshot"] for r in rows] == [*FILES[1:], None]


@pytest.mark.parametrize(
    "names, day, expect, fallback, following",
    [
        (["gtfs_2026-08-27.zip", "gtfs_2026-08-31.zip"], "2026-08-29", "gtfs_2026-08-27.zip", False, "gtfs_2026-08-31.zip"),
        (["gtfs_2026-08-27.zip", "gtfs_2026-08-31.zip"], "2026-08-31", "gtfs_2026-08-31.zip", False, None),
        (["gtfs_2026-08-27.zip", "gtfs_2026-08-31.zip"], "2026-09-05", "gtfs_2026-08-31.zip", False, None),
        (["gtfs_2026-08-27.zip", "gtfs_2026-08-31.zip"], "2026-08-01", "gtfs_2026-08-27.zip", True, "gtfs_2026-08-31.zip"),
        (FILES, "2026-09-10", FILES[0], False, FILES[1]),
        (FILES[:2], "2026-09-11", FILES[1], False, None),
    ],
)
def test_as_of(spark, names, day, expect, fallback, following):
    days = spark.createDataFrame([("c", dt.date.fromisoformat(day))], "city string, service_date date")
    row = snapshots.as_of(days, _catalogue(spark, names), ["city"]).first()
    assert (row["snapshot"], row["is_fallback"], row["next_snapshot"]) == (expect, fallback, following)


def test_signatures(spark):
    trips = spark.createDataFrame(
        [("s", "A", "R2"), ("s", "A", "R10"), ("s", "A", "R10"), ("s", "W", "R1"), ("s", "X", "R9"),
         ("t", "B", "R10"), ("t", "B", "R2"), ("t", "C", "R10")],
        "snapshot string, service_id string, route_id string",
    )
    dates = spark.createDataFrame(
        [("s", "A", "20260907", "1"), ("s", "A", "20260907", "1"), ("s", "W", "20260912", "1"),
         ("s", "X", "20260907", "2"), ("t", "B", "20260908", "1"), ("t", "C", "20260908", "1")],
        "snapshot string, service_id string, date string, exception_type string",
    )
    days = spark.createDataFrame(
        [("s", dt.date(2026, 9, 7)), ("s", dt.date(2026, 9, 12)), ("s", dt.date(2026, 9, 9)), ("t", dt.date(2026, 9, 8))],
        "snapshot string, service_date date",
    )
    sched = calendar.scheduled_trips(days, calendar.active_services(dates), trips)
    rows = {r["service_date"].day: r for r in calendar.signatures(days, sched).collect()}
    assert rows[7]["counts"] == {"R10": 2, "R2": 1}
    # renumbered services with the same counts sign alike; the weekend and the empty day do not
    assert rows[7]["signature_key"] == rows[8]["signature_key"]
    assert rows[12]["counts"] == {"R1": 1}
    assert (rows[9]["trip_count"], rows[9]["signature_key"]) == (0, "e3b0c44298fc1c14")


def test_churn_counts_a_vanished_route_whole(spark):
    schema = "day string, route_id string, trips bigint"
    a = spark.createDataFrame([("d", "R1", 10), ("d", "R2", 4)], schema)
    b = spark.createDataFrame([("d", "R1", 7), ("d", "R3", 2)], schema)
    assert calendar.churn(a, b, ["day"]).first()["churn"] == 3 + 4 + 2
