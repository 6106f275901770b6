import datetime as dt
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgrain.functions.geo import along_shape
from fleetgrain.functions.keys import bin_key, route_type_label, split_bin_key
from fleetgrain.operators import serve
from fleetgrain.sinks import write_geometry, write_slots
from tests.helpers import HOP_M, line_shapes

BINS = "bundle string, shape_key string, segment_index int, timeslot string, median_speed_ms double, n_samples bigint"


def test_simplification():
    line = np.array([(0, 0), (25, 0.4), (50, -0.6), (75, 0.9), (100, 0), (100, 50), (100, 100)], float)
    kept = line[serve.keep_vertices(line, 5.0)]
    assert kept.tolist() == [[0, 0], [100, 0], [100, 100]]
    # the distance is to the retained stretch, so a spur past its end stays
    spur = np.array([(0, 0), (50, 0), (-20, 0), (100, 0)], float)
    assert serve.keep_vertices(spur, 5.0).tolist() == [True, True, True, True]
    assert serve.keep_vertices(np.array([(0, 0), (0, 30), (0, 0)], float), 5.0).all()


def test_threshold_and_counts(spark):
    bins = spark.createDataFrame(
        [("p", "k", i, "08:00", 5.0, n) for i, n in enumerate((1, 2, 5))]
        + [("p", "gone", 0, "08:00", 5.0, 9), ("p", "k", 1, "09:00", 5.0, 1)],
        BINS,
    )
    assert serve.retained_bins(bins).count() == 3
    shapes = spark.createDataFrame([("k",)], "shape_key string")
    row = serve.bundle_counts(bins, shapes).first()
    assert (row["bins_before"], row["bins_after"], row["bins_dropped_pct"]) == (5, 3, 40.0)
    assert (row["segments_before"], row["segments_after"], row["segments_dropped_pct"]) == (4, 3, 25.0)
    assert (row["segments_missing"], row["shapes_observed"], row["shapes_written"]) == (1, 2, 1)
    kept = serve.retained_bins(bins)
    assert serve.unknown_segments(kept, shapes).count() == 1
    indexed = serve.index_segments(serve.retained_segments(kept, shapes))
    slots = serve.slot_bins(kept, indexed)
    assert slots.count() == 2  # the bin of the unknown shape drops out


def test_paths_offsets_and_documents(spark, tmp_path):
    shapes, key = line_shapes(spark)
    bins = spark.createDataFrame(
        [("p", key, i, slot, 5.0, 3) for i in (0, 3, 9) for slot in ("08:00", "09:00")], BINS
    )
    indexed = serve.index_segments(serve.retained_segments(bins, shapes))
    paths = indexed.join(serve.draw_paths(indexed, shapes), ["shape_key", "segment_index"])
    flat = serve.point_offsets(paths)
    rows = flat.orderBy("segment_idx").collect()
    assert [r["segment_index"] for r in rows] == [0, 3, 9]
    assert [r["point_offset"] for r in rows] == [0, 2, 4]
    top = math.degrees(10 * HOP_M / 6371000)
    assert rows[0]["points"][0]["lat"] == pytest.approx(0.0, abs=1e-5)
    assert rows[0]["points"][1]["lat"] == pytest.approx(math.degrees(200 / 6371000), abs=1e-5)
    # a segment past the end of the line is its end point
    assert [p["lat"] for p in rows[2]["points"]] == pytest.approx([top, top], abs=1e-5)
    slots = serve.slot_bins(bins, indexed)
    assert serve.undrawable(slots, flat).count() == 0
    assert serve.undrawable(slots, flat.filter("segment_idx > 0")).count() == 2
    assert serve.drawable_slots(slots, flat).count() == 6
    known = spark.createDataFrame(
        [(key, ["S1", "S2"], ["R1"], ["1"], 3)],
        "shape_key string, shape_ids array<string>, route_ids array<string>, route_names array<string>, route_type int",
    )
    document = serve.geometry_document(flat, serve.shape_table(indexed, known))
    row = document.first()
    assert len(row["point_offset"]) == 4 and row["point_offset"][-1] == len(row["lat"])
    assert (row["shape_keys"], row["shape_idx"], row["shape_ids"]) == ([key], [0, 0, 0], [["S1", "S2"]])
    assert (row["shape_route_type"], row["shape_route_ids"], row["segment_length_m"]) == ([3], [["R1"]], 200.0)
    write_geometry(document, str(tmp_path / "g"))
    write_slots(serve.slot_documents(slots), str(tmp_path / "s"))
    write_slots(serve.slot_documents(slots.filter("timeslot = '09:00'")), str(tmp_path / "s"))
    files = list((tmp_path / "s" / "bundle=p").glob("slot=*/*.json"))
    assert {f.parent.name for f in files} == {"slot=0900"}  # the old slot is gone
    assert json.loads(files[0].read_text())["speed_kmh"] == [18, 18, 18]


def test_documents_join_lists_of_slices(spark, monkeypatch):
    """A bundle's lists were made from one list of row objects, which did not fit an executor at 17 million segments."""
    monkeypatch.setattr(serve, "_SLICE", 3)
    rows = [("p", f"k{i // 4}", i % 4, i, [(float(i), 1.0), (float(i), 2.0)], 2 * i) for i in range(20)]
    paths = spark.createDataFrame(
        rows,
        "bundle string, shape_key string, segment_index int, segment_idx bigint, points array<struct<lat: double, lon: double>>, point_offset bigint",
    )
    table = spark.createDataFrame(
        [("p", i, f"k{i}", [f"S{i}"], [], [], None if i == 2 else 3) for i in range(5)],
        "bundle string, shape_idx bigint, shape_key string, shape_ids array<string>, route_ids array<string>, route_names array<string>, route_type int",
    )
    baseline = spark.createDataFrame([("p", i, 7) for i in range(0, 20, 2)], "bundle string, segment_idx bigint, typical_kmh int")
    for known, typical in ((None, [None] * 20), (baseline, [7, None] * 10)):
        (row,) = serve.geometry_document(paths.repartition(7), table.repartition(3), known).collect()
        assert row["shape_idx"] == [i // 4 for i in range(20)] and row["segment_index"] == [i % 4 for i in range(20)]
        assert row["point_offset"] == list(range(0, 41, 2)) and row["typical_kmh"] == typical
        assert row["lat"] == [float(i // 2) for i in range(40)] and row["lon"] == [1.0, 2.0] * 20
        assert row["shape_keys"] == [f"k{i}" for i in range(5)] and row["shape_ids"] == [[f"S{i}"] for i in range(5)]
        assert row["shape_route_type"] == [3, 3, None, 3, 3]


def test_numbering_reads_stored_paths(spark):
    """Paths were drawn again in each of the numbering's passes."""
    from registry.serving import geometry_offsets

    plan = geometry_offsets(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


def test_point_at_a_distance(spark):
    cum, xs = F.array(*map(F.lit, (0.0, 10.0, 10.0, 30.0))), F.array(*map(F.lit, (0.0, 4.0, 4.0, 8.0)))
    at = [-5.0, 0.0, 5.0, 10.0, 20.0, 30.0, 99.0]
    row = spark.range(1).select(*[along_shape(cum, xs, F.lit(d)).alias(f"d{i}") for i, d in enumerate(at)]).first()
    assert list(row) == [0.0, 0.0, 2.0, 4.0, 6.0, 8.0, 8.0]


def test_bent_line_keeps_its_corner(spark):
    xs, ys = [0.0, 50.0, 100.0, 100.0, 100.0], [0.0, 0.5, 0.0, 50.0, 100.0]
    cum = [0.0, *np.cumsum(np.hypot(np.diff(xs), np.diff(ys))).tolist()]
    shapes = spark.createDataFrame(
        [("k", xs, ys, cum, 42.0, 23.0)],
        "shape_key string, xs array<double>, ys array<double>, cum_dist array<double>, ref_lat_deg double, ref_lon double",
    )
    segments = spark.createDataFrame([("p", "k", 0)], "bundle string, shape_key string, segment_index int")
    points = serve.draw_paths(segments, shapes).first()["points"]
    assert len(points) == 3
    assert points[1]["lat"] == 42.0 and points[1]["lon"] == pytest.approx(23.00121, abs=1e-5)


@pytest.mark.parametrize(
    "typical, slot, flagged",
    [(20, 10, True), (10, 6.5, False), (100, 90, False), (20, 14, True), (20, 14.01, False),
     (10, 6, True), (10, 6.01, False), (None, 1, False)],
)
def test_slowdown(spark, typical, slot, flagged):
    kmh = F.lit(float(slot))
    base = F.lit(None if typical is None else float(typical)).cast("double")
    assert spark.range(1).select(serve.slowdown(kmh, base).alias("f")).first()["f"] is flagged


def test_baseline(spark):
    def rows(idx, speeds):
        return [("p", f"{i:02d}:00", idx, v, 3) for i, v in enumerate(speeds)]

    data = rows(0, [*range(10, 24), 90]) + rows(1, [20] * 14) + rows(2, [20] * 15)
    slots = spark.createDataFrame(
        data, "bundle string, timeslot string, segment_idx bigint, speed_kmh int, n_samples bigint"
    )
    base = {r["segment_idx"]: r["typical_kmh"] for r in serve.segment_baseline(slots).collect()}
    assert base == {0: 17, 1: None, 2: 20}


def test_speed_rounds_half_to_even(spark):
    bins = spark.createDataFrame([("p", "k", 0, s, v / 3.6, 2) for s, v in (("a", 2.5), ("b", 3.5))], BINS)
    indexed = spark.createDataFrame([("p", "k", 0, 0)], "bundle string, shape_key string, segment_index int, segment_idx int")
    assert [r["speed_kmh"] for r in serve.slot_bins(bins, indexed).orderBy("timeslot").collect()] == [2, 4]


def test_route_types(spark):
    segments = spark.createDataFrame(
        [("p", k, i) for i, k in enumerate(("a", "a", "b", "c"))], "bundle string, shape_key string, segment_idx int"
    )
    routes = spark.createDataFrame([("a", 3), ("b", 0), ("c", None)], "shape_key string, route_type int")
    typed = serve.with_route_type(segments, routes)
    assert [r["route_type"] for r in typed.orderBy("segment_idx").collect()] == [3, 3, 0, -1]
    present = {(r["route_type"], r["label"], r["segments"]) for r in serve.route_types_present(typed).collect()}
    assert present == {(-1, "Unknown type", 1), (0, "Tram", 1), (3, "Bus", 2)}
    assert serve.enabled_segments(typed, [3, -1]).count() == 3
    assert serve.enabled_segments(typed, []).count() == 0
    row = spark.range(1).select(route_type_label(F.lit(42)).alias("l")).first()
    assert row["l"] == "Type 42"


def test_mixed_route_types_give_null_and_newest_feed_wins(spark):
    trips = spark.createDataFrame(
        [("a", "R1", "S1"), ("a", "R2", "S1"), ("b", "R3", "S2"), ("a", "R1", "S2"), ("a", "R9", "")],
        "snapshot string, route_id string, shape_id string",
    )
    routes = spark.createDataFrame(
        [("a", "R1", "1", 0), ("a", "R2", "", 3), ("b", "R3", "3", 3)],
        "snapshot string, route_id string, route_short_name string, route_type int",
    )
    bridge = spark.createDataFrame([("k1", "S1"), ("k2", "S2"), ("k3", "S3")], "shape_key string, shape_id string")
    feeds = spark.createDataFrame([("a", 1), ("b", 2)], "snapshot string, seq int")
    rows = {r["shape_key"]: r for r in serve.shape_routes(bridge, trips, routes, feeds).collect()}
    assert (rows["k1"]["route_ids"], rows["k1"]["route_names"], rows["k1"]["route_type"]) == (["R1", "R2"], ["1", "R2"], None)
    assert (rows["k2"]["route_ids"], rows["k2"]["route_type"]) == (["R3"], 3)
    assert (rows["k3"]["route_ids"], rows["k3"]["route_type"]) == ([], None)


def test_incomplete_days(spark):
    days = spark.createDataFrame([("b", dt.date(2026, 9, d)) for d in (1, 2, 3, 4)], "bundle string, service_date date")
    manifests = spark.createDataFrame(
        [(dt.date(2026, 9, 1), True, 50.0), (dt.date(2026, 9, 2), False, 97.5), (dt.date(2026, 9, 3), False, 99.0),
         (dt.date(2026, 9, 4), False, None)],
        "service_date date, day_in_progress boolean, coverage_pct double",
    )
    notes = {r["service_date"].day: r["note"] for r in serve.incomplete_days(days, manifests).collect()}
    assert notes.keys() == {1, 2}
    assert notes[2] == "only 97.5% coverage of the calendar day"
    bundles = spark.createDataFrame(
        [("x", ["d1", "d2"], {"d2": "n", "d9": "n"}), ("y", ["d1"], {"d9": "n"})],
        "bundle string, days_in_median array<string>, incomplete_days map<string,string>",
    )
    assert [(r["bundle"], r["drawn_incomplete"]) for r in serve.drawn_incomplete(bundles).collect()] == [("x", ["d2"])]


def test_keys_and_slot_choice(spark):
    df = spark.createDataFrame([("k", 7, "08:15")], "shape_key string, segment_index int, timeslot string")
    keyed = df.select(bin_key(F.col("shape_key"), F.col("segment_index"), F.col("timeslot")).alias("b"))
    assert keyed.first()["b"] == "k|7|08:15"
    assert keyed.select(*split_bin_key(F.col("b"))).collect() == df.collect()
    slots = F.array(*[F.lit(s) for s in ("07:00", "08:00", "09:00")])
    picks = [
        serve.pick_slot(slots, F.lit("09:00")),
        serve.pick_slot(slots, F.lit("23:00")),
        serve.pick_slot(F.array(F.lit("01:00")), F.lit(None).cast("string")),
    ]
    row = spark.range(1).select(*[p.alias(f"p{i}") for i, p in enumerate(picks)]).first()
    assert tuple(row) == (2, 1, 0)


def _recursive(line, tolerance_m):
    """Douglas-Peucker by the book, for comparison only."""
    if len(line) < 3:
        return [True] * len(line)
    base, rel = line[-1] - line[0], line[1:-1] - line[0]
    size = (base * base).sum()
    along = np.clip((rel * base).sum(axis=1) / size, 0, 1) if size else np.zeros(len(rel))
    off = np.hypot(*(rel - along[:, None] * base).T)
    far = int(off.argmax()) + 1
    if off[far - 1] <= tolerance_m:
        return [True, *[False] * (len(line) - 2), True]
    return [*_recursive(line[: far + 1], tolerance_m), *_recursive(line[far:], tolerance_m)[1:]]


def test_many_lines_are_simplified_like_each_alone():
    rng = np.random.default_rng(2)
    lines = [np.cumsum(rng.normal(0, 8, (int(n), 2)), axis=0) for n in rng.integers(2, 80, 120)]
    lines += [np.repeat(lines[0], 3, axis=0), np.zeros((5, 2)), np.array([(0, 0), (0, 30), (0, 0)], float)]
    sizes = np.array([len(line) for line in lines])
    got = serve.kept_vertices(np.concatenate(lines), sizes, 5.0)
    want = [k for line in lines for k in _recursive(line, 5.0)]
    assert got.tolist() == want and 0 < sum(want) < len(want)


def test_stretches_hold_their_ends_and_the_vertices_between():
    x, y = np.array([0.0, 10, 20, 20, 20]), np.array([0.0, 0, 0, 15, 30])
    cum = np.array([0.0, 10, 20, 35, 50])
    points, sizes = serve.cut_line(x, y, cum, np.array([3, 0, 1, 9]), 15.0)
    cut = [p.tolist() for p in np.split(points, np.cumsum(sizes)[:-1])]
    assert cut[0] == [[20, 25], [20, 30]] and cut[1] == [[0, 0], [10, 0], [15, 0]]
    assert cut[2] == [[15, 0], [20, 0], [20, 10]] and cut[3] == [[20, 30], [20, 30]]


def test_shapes_are_numbered_in_key_order_across_slices(spark):
    keys = ["0010", "0011", "001f", "0020", "a", "ab1", "abc0", "abc1"]
    rows = [(b, k, i) for b, some in (("p", keys), ("q", keys[3:6])) for k in some for i in (2, 0, 2)]
    segments = spark.createDataFrame(rows, "bundle string, shape_key string, segment_index int").distinct()
    routes = spark.createDataFrame(
        [("ab1", ["S"], ["R", "T"], ["1"], None)],
        "shape_key string, shape_ids array<string>, route_ids array<string>, route_names array<string>, route_type int",
    )
    table = {(r["bundle"], r["shape_key"]): r for r in serve.shape_table(segments, routes).collect()}
    assert [table["p", k]["shape_idx"] for k in keys] == list(range(8))
    assert [table["q", k]["shape_idx"] for k in keys[3:6]] == [0, 1, 2]
    assert table["p", "0020"]["route_ids"] == [] and table["q", "ab1"]["route_ids"] == ["R", "T"]
    placed = serve.index_segments(segments)
    order = [(r["shape_key"], r["segment_index"]) for r in placed.filter("bundle = 'p'").orderBy("segment_idx").collect()]
    assert order == [(k, i) for k in keys for i in (0, 2)]
    assert serve.shape_table(segments.limit(0), routes).count() == 0
