from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetgrain.functions import clock, geo
from fleetgrain.functions.keys import geometry_key
from fleetgrain.operators import bins, shapes as shape_ops, walk
from fleetgrain.params import WalkParams
from fleetgrain.sources import jsonl
from tests.helpers import (
    DAY,
    HOP_M,
    TZ,
    fixes,
    line_points,
    line_shapes,
    plan_and_trips,
    plain_walk,
    random_trip,
    rejects,
    walk_line,
)

PARAMS = WalkParams(timezone=TZ)


def test_haversine_degree(spark):
    row = spark.range(1).select(geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)).alias("m")).first()
    assert row["m"] == pytest.approx(111_320, abs=200)


def test_cumulative_distance(spark):
    shapes, _ = line_shapes(spark)
    cum = shapes.first()["cum_dist"]
    assert cum == pytest.approx([i * HOP_M for i in range(11)], abs=1)
    long = shape_ops.vertex_distances(line_points(spark), ["shape_id"]).orderBy("shape_pt_sequence").collect()
    assert [r["cum_dist"] for r in long] == pytest.approx(cum)


def test_onto_segment_column(spark):
    lit = F.lit
    on = geo.onto_segment(lit(5.0), lit(3.0), lit(0.0), lit(0.0), lit(10.0), lit(0.0))
    point = geo.onto_segment(lit(3.0), lit(4.0), lit(0.0), lit(0.0), lit(0.0), lit(0.0))
    row = spark.range(1).select(on.alias("a"), point.alias("b")).first()
    assert (row["a"]["fraction"], row["a"]["distance"]) == (0.5, 3.0)
    assert (row["b"]["fraction"], row["b"]["distance"]) == (0.0, 5.0)


@pytest.mark.parametrize(
    "epoch, slot",
    [(1787864432, "00:00"), (1787915640, "14:00"), (1787915640 + 60, "14:15")],
)
def test_timeslot(spark, epoch, slot):
    row = spark.range(1).select(clock.timeslot(F.lit(epoch), TZ).alias("s")).first()
    assert row["s"] == slot


def test_one_sample(spark):
    steps = walk_line(spark, [(1000, 0.002), (1045, 0.003)])
    assert rejects(steps) == {}
    row = walk.samples(steps, PARAMS).collect()
    assert len(row) == 1
    assert row[0]["speed_raw"] == pytest.approx(HOP_M / 45, abs=0.05)
    assert (row[0]["route_id"], row[0]["shape_id"], row[0]["dt_sec"]) == ("R1", "S1", 45)
    assert row[0]["segment_index"] == 1


@pytest.mark.parametrize(
    "rows, reason",
    [
        ([(1000, 0.001), (1601, 0.002)], walk.LONG),
        ([(1000, 0.001), (1000, 0.002)], walk.NOT_LATER),
        ([(1000, 0.005), (1045, 0.001)], walk.BACKWARD),
        ([(1000, 0.0), (1030, 0.010)], walk.FAST),
        ([(1000, 0.001), (1001, 0.001)], walk.SHORT),
        ([(1000, 0.001), (1022, 0.002)], walk.SHORT),
    ],
)
def test_rejections(spark, rows, reason):
    assert rejects(walk_line(spark, rows)) == {reason: 1}


def test_23_seconds_is_long_enough(spark):
    assert rejects(walk_line(spark, [(1000, 0.001), (1023, 0.002)])) == {}


def test_short_gap_keeps_the_anchor(spark):
    steps = walk_line(spark, [(1000, 0.001), (1001, 0.001), (1046, 0.002)])
    assert rejects(steps) == {walk.SHORT: 1}
    sample = walk.samples(steps, PARAMS).collect()
    assert [(s["from_ts"], s["dt_sec"]) for s in sample] == [(1000, 46)]


def test_small_step_back_is_accepted(spark):
    sample = walk.samples(walk_line(spark, [(1000, 0.003), (1045, 0.003 - 25 / 111_195)]), PARAMS).collect()
    assert len(sample) == 1 and sample[0]["speed_raw"] < 0


def test_feed_speed_is_the_later_fix_and_its_unit(spark):
    rows = [(1000, 0.002, 0.0, 99.0), (1045, 0.003, 0.0, 2.5)]
    assert walk.samples(walk_line(spark, rows), PARAMS).first()["feed_speed_kmh"] == 2.5
    ms = WalkParams(timezone=TZ, speed_field_unit="ms")
    assert walk.samples(walk_line(spark, rows, ms), ms).first()["feed_speed_kmh"] == 9.0


def test_validation_of_equal_speed(spark):
    rows = [(1000, 0.002, 0.0, None), (1045, 0.003, 0.0, HOP_M / 45 * 3.6)]
    row = bins.feed_speed_validation(walk.samples(walk_line(spark, rows), PARAMS)).first()
    assert row["n_compared"] == 1 and row["median_abs_diff_kmh"] < 0.01 and row["pct_over_threshold"] == 0


def test_unknown_trip_missing_keys_and_missing_shape(spark):
    shapes, key = line_shapes(spark)
    plan, trips = plan_and_trips(spark, [("T1", "R1", "S1", key), ("T2", "R1", "S2", "gone")])
    rows = [
        (1000, 0.001, 0.0, None, "V1", "other"),
        (1000, 0.001, 0.0, None, None, "T1"),
        (1000, 0.001, 0.0, None, "V1", ""),
        (1000, 0.001, 0.0, None, "V1", "T2"),
        (1045, 0.001, 0.0, None, "V1", "T2"),
        (1000, 0.001, 0.0, None, "V1", "T1"),
    ]
    positions = fixes(spark, rows)
    outcomes = walk.outcomes(walk.walk(positions, plan, trips, shapes, PARAMS, ["seq"])).unionByName(
        walk.keyless_records(positions)
    )
    total = bins.day_counters(outcomes).filter("service_date IS NULL").first()
    assert (total["records"], total[walk.NO_TRIP], total[walk.NO_SHAPE]) == (6, 3, 2)
    assert total["records"] == total[walk.NO_TRIP] + total[walk.NO_SHAPE] + total["walks"] + total["pairs"]


def test_next_feed_answers_only_for_unknown_trips(spark):
    plan = spark.createDataFrame([(DAY, "a", "b")], "service_date date, snapshot string, next_snapshot string")
    trips = spark.createDataFrame(
        [("a", "T1", "own", "S1", "k"), ("b", "T1", "later", "S1", "k"), ("b", "T2", "later", "S1", "k"),
         ("b", "T3", "later", "", "k")],
        "snapshot string, trip_id string, route_id string, shape_id string, shape_key string",
    )
    asked = spark.createDataFrame([(DAY, f"T{i}") for i in range(1, 5)], "service_date date, trip_id string")
    found = walk.resolve_trips(asked, plan, trips)
    assert {(r["trip_id"], r["route_id"], r["from_next"]) for r in found.collect()} == {
        ("T1", "own", False),
        ("T2", "later", True),
        ("T3", None, False),
        ("T4", None, False),
    }
    rows = [(1000, 0.001, 0.0, None, "V1", "T2"), (1045, 0.002, 0.0, None, None, "T2")]
    counts = walk.next_feed_counts(fixes(spark, rows), plan, trips).first()
    # counted before the missing vehicle is looked at
    assert (counts["records_from_next_feed"], counts["trips_from_next_feed"]) == (2, 1)


def _random_inputs(spark, seeds):
    points, records, plain = [], [], {}
    for seed in seeds:
        line, trip = random_trip(seed)
        points += [(f"S{seed}", i, a, b) for i, (a, b) in enumerate(line)]
        records += [(ts, lat, lon, None, f"V{seed}", f"T{seed}") for ts, lat, lon in trip]
        plain[seed] = trip
    schema = "shape_id string, shape_pt_sequence int, shape_pt_lat double, shape_pt_lon double"
    keyed = shape_ops.keyed_points(spark.createDataFrame(points, schema), ["shape_id"])
    shapes = shape_ops.build_shapes(keyed)
    keys = {r["shape_id"]: r["shape_key"] for r in keyed.collect()}
    dims = (*plan_and_trips(spark, [(f"T{s}", "R", f"S{s}", keys[f"S{s}"]) for s in seeds]), shapes)
    by_key = {r["shape_key"]: r for r in shapes.collect()}
    return fixes(spark, records), dims, {s: (by_key[keys[f"S{s}"]], plain[s]) for s in seeds}


def test_kernel_equals_plain_walk_on_random_trips(spark):
    seeds = range(12)
    positions, dims, expected = _random_inputs(spark, seeds)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # walks span batches
    try:
        steps = walk.walk(positions, *dims, PARAMS, ["seq"]).collect()
        for seed in seeds:
            shape, records = expected[seed]
            by_second = {}
            for ts, verdict, dist in plain_walk(shape, records, PARAMS):
                by_second.setdefault(ts, []).append((verdict, dist))
            mine = {r["snapshot_ts"]: r for r in steps if r["trip_id"] == f"T{seed}"}
            assert mine.keys() == by_second.keys()
            for ts, judged in by_second.items():
                row = mine[ts]
                assert (row["verdict"], row["n"]) == (judged[0][0], len(judged)), (seed, ts)
                if judged[0][1] is not None:
                    assert row["dist_m"] == pytest.approx(judged[0][1], abs=1e-6)
        seen = {r["verdict"] for r in steps}
        assert {walk.SHORT, walk.LONG, walk.BACKWARD, walk.FAST, walk.ACCEPTED} <= seen
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_walk_goes_on_from_anchors(spark):
    positions, dims, _ = _random_inputs(spark, range(3))
    columns = ["trip_id", "snapshot_ts", "n", "verdict", "from_ts", "dist_m", "delta_m"]
    whole = walk.walk(positions, *dims, PARAMS, ["seq"]).select(*columns)
    middle = positions.agg(F.percentile_approx("snapshot_ts", 0.5).alias("m")).first()["m"]
    early = walk.walk(positions.filter(F.col("snapshot_ts") <= middle), *dims, PARAMS, ["seq"])
    anchors = early.groupBy(*walk.WALK_KEYS).agg(F.max_by(F.struct("anchor_ts", "anchor_m"), "snapshot_ts").alias("a"))
    late = walk.walk(
        positions.filter(F.col("snapshot_ts") > middle),
        *dims,
        PARAMS,
        ["seq"],
        anchors=anchors.select(*walk.WALK_KEYS, "a.*"),
    )
    parts = early.select(*columns).unionByName(late.select(*columns))
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_seconds_collapse_by_hash_in_the_readers_order(spark, tmp_path):
    (tmp_path / "2026-09-01.jsonl").write_text('{"snapshot_ts": 1, "vehicle_id": "V", "trip_id": "T", "lat": 1.0, "lon": 2.0}\n')
    plan = _plan(walk.collapse_seconds(jsonl.read_positions(spark, str(tmp_path)), jsonl.FILE_ORDER))
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan


def test_lookups_have_no_common_null_key(spark):
    """Every row the own feed knows would meet in one task if it asked the next feed for a null name."""
    plan, trips = plan_and_trips(spark, [(f"T{i}", "R", "S", "k") for i in range(50)])
    asked = spark.createDataFrame([(DAY, f"T{i}") for i in range(50)] * 40, "service_date date, trip_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = walk.resolve_trips(asked, plan, trips)
        sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2000 and max(sizes) < 1200


def test_lines_are_not_sent_through_the_driver(spark):
    """Spark took 323 MB of lines for less than its limit of a broadcast, 10 MB."""
    judged = walk_line(spark, [(1000, 0.0), (1023, 0.001)])
    joins = [line for line in _plan(judged).splitlines() if "Join" in line and ("shape_key#" in line or "_asked#" in line)]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_rows_without_a_trip_ask_for_lines_apart(spark):
    heads = spark.createDataFrame([(f"T{i}", None) for i in range(200)], "trip_id string, shape_key string")
    shapes, _ = line_shapes(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = walk.with_lines(heads, shapes).select("xs", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(found) == 200 and len({r["part"] for r in found}) > 1 and {r["xs"] for r in found} == {None}


def test_lines_are_measured_some_at_a_time(monkeypatch):
    """What a worker holds must not follow the rows of a batch."""
    rng = np.random.default_rng(5)
    sizes = [2, 40, 3, 3, 90, 2]
    lats, lons = ([rng.uniform(20, 40, n).tolist() for n in sizes] for _ in range(2))
    batch = pa.RecordBatch.from_arrays([pa.array(list("abcdef")), pa.array(lats), pa.array(lons)], names=["shape_key", "lats", "lons"])
    whole = pa.Table.from_batches(shape_ops._measure([batch])).to_pylist()
    monkeypatch.setattr(shape_ops, "_POINTS", 45)
    parts = list(shape_ops._measure([batch.slice(1)]))
    assert [p.num_rows for p in parts] == [2, 1, 1, 1]
    assert pa.Table.from_batches(parts).to_pylist() == whole[1:]
    for row, lat, lon in zip(whole, lats, lons, strict=True):
        assert (row["ref_lat_deg"], row["ref_lon"]) == (float(np.mean(lat)), lon[0])
        assert len(row["cum_dist"]) == len(lat) and row["cum_dist"][0] == 0 and (np.diff(row["cum_dist"]) > 0).all()
        assert row["ys"] == pytest.approx(np.radians(np.array(lat) - np.mean(lat)) * 6371000)


def test_a_task_remembers_segments_and_not_lines(monkeypatch):
    monkeypatch.setattr(walk, "_SEGMENTS_KEPT", 100)
    flat = np.arange(31.0)

    class Heads:
        trips, anchors, has_line = [("R", "S", f"k{i}", False) for i in range(9)], [(None, None)] * 9, [True] * 9

        def line(self, i):
            return walk._Line(flat, flat, flat, 42.0, 20.0)

    state = walk._Walk(PARAMS)
    for i in range(9):
        state.begin(Heads(), i)
        assert state.line is state.lines[f"k{i}"] and sum(line.size for line in state.lines.values()) <= 100
        assert state.line.cum.base is None  # holds no batch


def test_a_short_line_has_no_boxes():
    """Most walks have a line of their own, and boxes that nothing looks at were half of its cost."""
    xs = np.arange(40.0) ** 1.5
    line = walk._Line(xs, xs * 2, xs * 3, 42.0, 20.0)
    assert not hasattr(line, "west") and line.ax.shape == (1, 39) and line.ax.base.base is None
    dist, near = line.nearest(np.array([xs[7], -5.0]), np.array([xs[7] * 2, -9.0]))
    assert dist.tolist() == [xs[7] * 3, 0.0] and near.tolist() == [6, 0]


def test_totals_of_bins_need_no_medians(spark):
    from registry.walking import typical_bin_totals

    plan = _plan(typical_bin_totals(spark, "/root/testdata/sf0.001"))
    assert "Window" not in plan and "HashAggregate" in plan


def test_unplanned_snapshots_are_not_looked_at(spark):
    plan = spark.createDataFrame([(DAY, "a", None)], "service_date date, snapshot string, next_snapshot string")
    trips = spark.createDataFrame(
        [("a", "T1", "R", "S", "k"), ("old", "T1", "R", "S", "k")],
        "snapshot string, trip_id string, route_id string, shape_id string, shape_key string",
    )
    assert [r["snapshot"] for r in walk.planned_trips(trips, plan).collect()] == ["a"]


def test_fixes_without_a_position_are_counted_and_poison_nothing(spark):
    shapes, key = line_shapes(spark)
    plan, trips = plan_and_trips(spark, [("T1", "R1", "S1", key)])
    rows = [(1000, 0.001, 0.0), (1045, None, 0.0), (1090, 0.003, 0.0), (1135, float("nan"), 0.0), (1180, 0.005, float("inf")), (1225, 0.006, 0.0)]
    positions = fixes(spark, rows)
    steps = walk.walk(positions, plan, trips, shapes, PARAMS, ["seq"])
    assert [(r["snapshot_ts"], r["verdict"]) for r in steps.orderBy("snapshot_ts").collect()] == [
        (1000, walk.HEAD), (1090, walk.ACCEPTED), (1225, walk.ACCEPTED),
    ]
    total = bins.day_counters(walk.outcomes(steps).unionByName(walk.unusable_fixes(positions))).filter("service_date IS NULL")
    row = total.first()
    assert (row["records"], row["samples"], row[walk.NO_POSITION]) == (6, 2, 3)


def test_samples_pool_over_periods_apart(spark):
    rows = [
        (day, "k", 1, "08:00", speed)
        for day, speeds in (("2026-07-01", (10.0, 10.0)), ("2026-10-01", (4.0, 4.0)), ("2026-10-03", (99.0,)))
        for speed in speeds
    ]
    samples = spark.createDataFrame(
        rows, "d string, shape_key string, segment_index int, timeslot string, speed_raw double"
    ).withColumn("service_date", F.to_date("d"))
    plan = spark.createDataFrame(
        [("2026-07-01", "summer"), ("2026-10-01", "autumn"), ("2026-10-03", None)], "d string, period_key string"
    ).withColumn("service_date", F.to_date("d"))
    out = bins.typical_bins(samples, plan)
    assert {(r["period_key"], r["median_speed_ms"], r["n_samples"]) for r in out.collect()} == {
        ("summer", 10.0, 2),
        ("autumn", 4.0, 2),
    }
    totals = bins.bin_totals(out).first()
    assert (totals["segment_count"], totals["distinct_segment_count"]) == (2, 1)
    assert {r["bin_count"] for r in bins.bins_per_period(out).collect()} == {1}


def test_day_bins(spark):
    rows = [("2026-09-05", "k", 1, "08:00", 1.0), ("2026-09-05", "k", 1, "08:00", 3.0)]
    samples = spark.createDataFrame(
        rows, "service_date string, shape_key string, segment_index int, timeslot string, speed_ms double"
    )
    row = bins.day_bins(samples).first()
    assert (row["median_speed_ms"], row["n_samples"]) == (2.0, 2)


def _hairpin(n):
    rng = np.random.default_rng(n)
    t = np.linspace(0.0, 200.0 * n, n)
    lat = 38 + np.degrees(np.minimum(t, t[-1] - t) / 6371000) + rng.normal(0, 5e-5, n)
    lon = 23.7 + 2e-3 * np.sin(t / 1500) + rng.normal(0, 5e-5, n)
    if n > 4:
        lat[3], lon[3] = lat[2], lon[2]  # a segment of no length
    ref = float(lat.mean())
    xs, ys = np.radians(lon - lon[0]) * np.cos(np.radians(ref)) * 6371000, np.radians(lat - ref) * 6371000
    cum = np.concatenate([[0.0], np.cumsum(np.hypot(np.diff(xs), np.diff(ys)))])
    return walk._Line(xs, ys, cum, ref, float(lon[0])), lat, lon, xs, ys, cum


@pytest.mark.parametrize("n", [2, 3, 64, 65, 66, 67, 82, 400, 1501])
def test_boxes_lose_no_nearest_segment(n):
    line, lat, lon, xs, ys, cum = _hairpin(n)
    rng = np.random.default_rng(7)
    near = rng.integers(0, n, 300)
    off = np.concatenate([np.zeros(100), rng.normal(0, 3e-4, 100), rng.normal(0, 2.0, 100)])
    x, y = line.plane(lat[near] + off, lon[near] - off)
    full, segment = line.nearest(x, y)
    dx, dy = np.diff(xs), np.diff(ys)
    for i in range(len(x)):
        len_sq = np.where(dx * dx + dy * dy > 0, dx * dx + dy * dy, 1.0)
        frac = np.clip(((x[i] - xs[:-1]) * dx + (y[i] - ys[:-1]) * dy) / len_sq, 0, 1)
        far = (x[i] - xs[:-1] - frac * dx) ** 2 + (y[i] - ys[:-1] - frac * dy) ** 2
        j = int(far.argmin())
        # equally near neighbours share the vertex, so the distance is what must agree
        assert full[i] == pytest.approx(cum[j] + frac[j] * (cum[j + 1] - cum[j]), abs=1e-5)
        assert far[segment[i]] == pytest.approx(far[j], abs=1e-6)
        lo, hi = n // 3, max(n // 3, n // 2 - 1)
        k = lo + int(far[lo : hi + 1].argmin())
        assert line.nearest_between(x[i], y[i], lo, min(hi, n - 2)) == pytest.approx(
            cum[k] + frac[k] * (cum[k + 1] - cum[k]), abs=1e-5
        ) if lo <= n - 2 else True


def test_boxes_of_a_line_with_odd_vertices():
    line, lat, lon, xs, ys, cum = _hairpin(120)
    xs[60] = np.nan
    odd = walk._Line(xs, ys, cum, line.ref_lat, line.ref_lon)
    full, segment = odd.nearest(*odd.plane(lat[:20], lon[:20]))
    assert len(full) == len(segment) == 20


def test_boxes_skip_most_segments():
    line, lat, lon, *_ = _hairpin(1501)
    x, y = line.plane(lat + 1e-4, lon)
    opened = line._maybe_nearest(x[:, None], y[:, None]).sum() * line.run
    assert opened < 0.15 * len(x) * line.size


def test_window_decides_on_lines_that_come_back(spark):
    import driver_views as views
    from registry.walking import trip_walk_bent

    sf = "/root/testdata/sf0.001"
    narrow = {(r["vehicle_id"], r["snapshot_ts"]): r["dist_m"] for r in trip_walk_bent(spark, sf).collect()}
    kept = views.BENT
    try:
        views.BENT = replace(kept, search_margin_m=1e9)
        wide = {(r["vehicle_id"], r["snapshot_ts"]): r["dist_m"] for r in trip_walk_bent(spark, sf).collect()}
    finally:
        views.BENT = kept
    assert narrow.keys() == wide.keys()
    moved = [k for k in narrow if narrow[k] is not None and wide[k] is not None and abs(narrow[k] - wide[k]) > 1000]
    assert len(moved) > 0.05 * len(narrow)


def test_geometry_keys_of_python_are_those_of_the_formatter(spark):
    """Ties of the sixth decimal round half up in one and by their binary value in the other, so they are left to the formatter."""
    odd = [0.1234565, 2.0000005, -0.0, -3e-8, 5e-7, 999.9999999, 1e9, float("nan"), float("inf"), None, 41.25, 0.5000015]
    rows = [("s", f"L{k}", i, v, 20.0 + i / 7) for k, v in enumerate(odd) for i in range(3)]
    rows += [("s", f"M{k}", i, 40 + (k * 7919 + i) / 9973, -20 - i / 7) for k in range(50) for i in range(2 + k % 5)]
    points = spark.createDataFrame(rows, "snapshot string, shape_id string, shape_pt_sequence int, shape_pt_lat double, shape_pt_lon double")
    keyed = shape_ops.keyed_points(points, ["snapshot", "shape_id"])
    assert keyed.columns == ["snapshot", "shape_id", "points", "shape_key"]
    got = keyed.withColumn("want", geometry_key(F.col("points"))).collect()
    assert len(got) == len(odd) + 50 and all(r["shape_key"] == r["want"] for r in got)
    batch = shape_ops.ordered_points(points, ["snapshot", "shape_id"]).toArrow().to_batches()
    made = {r["shape_id"]: r["clear_key"] for b in shape_ops._with_clear_keys(iter(batch)) for r in b.to_pylist()}
    assert made["L0"] is None and made["L9"] is None and made["L6"] is None and made["L10"] and made["M3"]
