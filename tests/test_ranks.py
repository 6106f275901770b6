import random
import statistics

import pytest
from pyspark.sql import functions as F

from fleetgrain.operators import ranks
from fleetgrain.operators.sequences import lag_in_buckets, running_sum_in_buckets


def _values(seed=3):
    rng = random.Random(seed)
    groups = {
        "hot": [rng.gauss(5, 3) for _ in range(3001)],
        "even": [rng.uniform(-4, 4) for _ in range(800)],
        "repeats": [rng.choice([1.25, 1.25, 2.5, -3.0]) for _ in range(900)],
        "one": [7.5],
        "two": [1.0, 4.0],
    }
    return groups, [(k, v) for k, vs in groups.items() for v in vs]


def test_median_and_ranks(spark):
    groups, rows = _values()
    df = spark.createDataFrame(rows, "k string, v double")
    medians = {r["k"]: r for r in ranks.exact_median(df, ["k"], "v", "m").collect()}
    picks = {"q1": ranks.lower_quarter, "q3": ranks.upper_quarter}
    placed = {r["k"]: r for r in ranks.order_stats(df, ["k"], "v", picks).collect()}
    assert medians.keys() == groups.keys() == placed.keys()
    for key, values in groups.items():
        ordered, n = sorted(values), len(values)
        assert medians[key]["m"] == pytest.approx(statistics.median(values), abs=1e-12)
        assert medians[key]["n"] == placed[key]["n"] == n
        assert placed[key]["q1"] == ordered[n // 4] and placed[key]["q3"] == ordered[3 * n // 4]


def test_any_bucket_width_gives_the_same(spark):
    groups, rows = _values(9)
    df = spark.createDataFrame(rows, "k string, v double")
    for width in (100.0, 0.1, 1e-5):
        for r in ranks.exact_median(df, ["k"], "v", "m", width).collect():
            assert r["m"] == pytest.approx(statistics.median(groups[r["k"]]), abs=1e-12)


@pytest.mark.parametrize("finer", [(0.1,), (1e-5, 1e-8)])
def test_finer_buckets_give_the_same(spark, finer):
    groups, rows = _values(5)
    groups["odd"] = [float("inf"), -0.0, 0.0, 1e300, -1e300, 5e-324, 1e-9, 2e-9]
    df = spark.createDataFrame([*rows, *(("odd", v) for v in groups["odd"]), ("odd", None)], "k string, v double")
    picks = {"q1": ranks.lower_quarter, "lo": ranks.lower_middle, "q3": ranks.upper_quarter}
    for r in ranks.order_stats(df, ["k"], "v", picks, 1.0, finer).collect():
        ordered, n = sorted(groups[r["k"]]), len(groups[r["k"]])
        assert (r["n"], r["q1"], r["lo"], r["q3"]) == (n, ordered[n // 4], ordered[(n - 1) // 2], ordered[3 * n // 4])


def test_a_group_of_the_whole_table_is_many_small_ones(spark):
    """200,000 values in one coarse bucket, at most five of them in a narrow one."""
    df = spark.range(200_000).selectExpr("'all' AS k", "5.001 + (id * 7919 % 200000) / 4e7 AS v")
    held = {w: df.groupBy(ranks._bucket("v", w)).count().agg(F.max("count")).first()[0] for w in (ranks.BUCKET_WIDTH, *ranks.FINER)}
    assert held[ranks.BUCKET_WIDTH] == 200_000 and held[ranks.FINER[-1]] <= 5
    found = ranks.exact_median(df, ["k"], "v", "m", finer=ranks.FINER).first()
    assert found["n"] == 200_000 and found["m"] == pytest.approx(5.001 + 99_999.5 / 4e7, abs=1e-12)


def test_odd_values_have_a_place(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", v) for v in (nan, 1.0, inf, -inf, 1e300, -1e300, None, 2e300)] + [(None, 3.0), (None, 5.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    at = {f"r{i}": (lambda n, i=i: F.least(n - 1, F.lit(i))) for i in range(7)}
    got = {r["k"]: r for r in ranks.order_stats(df, ["k"], "v", at).collect()}
    assert got.keys() == {"a", None}  # a group of nulls only has no ranks
    assert [got["a"][f"r{i}"] for i in range(6)] == [-inf, -1e300, 1.0, 1e300, 2e300, inf]
    assert got["a"]["r6"] != got["a"]["r6"] and got["a"]["n"] == 7
    assert ranks.exact_median(df, ["k"], "v", "m").filter("k IS NULL").first()["m"] == 4.0


def test_nothing_runs_while_the_plan_is_built(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "CAST(raise_error('ran') AS DOUBLE) AS v")
    ranks.exact_median(df, ["k"], "v", "m")


def test_lag_and_running_sum_cross_buckets(spark):
    rng = random.Random(5)
    rows = sorted({(rng.choice("ab"), rng.randrange(0, 5000)) for _ in range(400)})
    df = spark.createDataFrame(rows, "k string, t int").withColumn("b", F.floor(F.col("t") / 300))
    lagged = lag_in_buckets(df, ["k"], ["t"], F.col("b"), {"before": F.col("t")}).collect()
    summed = running_sum_in_buckets(df, ["k"], ["t"], F.col("b"), F.col("t"), "upto").collect()
    for key in "ab":
        times = [t for k, t in rows if k == key]
        before = {r["t"]: r["before"] for r in lagged if r["k"] == key}
        assert before == dict(zip(times, [None, *times[:-1]]))
        upto, total = {r["t"]: r["upto"] for r in summed if r["k"] == key}, 0
        for t in times:
            total += t
            assert upto[t] == total
