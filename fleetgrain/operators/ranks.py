"""Exact medians and order statistics, one plan for groups of any size.

No group ever reaches one task whole. Values are counted per group and coarse
bucket, which combines before it shuffles; the bucket that holds a wanted rank
is read off the running counts of that small histogram; and only values of such
buckets are looked at again, as distinct values with their counts. A group as
large as the table counts equal values first and is refined by narrower buckets
inside the chosen one, so that no task meets more values than fit a narrow
bucket. Ranks are kept as numbers, so nothing runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_WIDTH = 1e-2
FINER = (1e-7,)  # for one group over a whole table of speeds: 100,000 buckets in a coarse one
_LARGEST = 1e15  # buckets beyond it are one; inside a bucket values are still told apart

Rank = Callable[[Column], Column]


def lower_middle(n: Column) -> Column:
    return F.floor((n - 1) / 2)


def upper_middle(n: Column) -> Column:
    return F.floor(n / 2)


def lower_quarter(n: Column) -> Column:
    return F.floor(n / 4)


def upper_quarter(n: Column) -> Column:
    return F.floor(n * 3 / 4)


def _bucket(value: str, width: float) -> Column:
    """Buckets in the order of their values; one for what is no number, which sorts last."""
    scaled = F.col(value).cast("double") / width
    kept = F.greatest(F.least(scaled, F.lit(_LARGEST)), F.lit(-_LARGEST))
    return F.when(F.isnan(scaled), F.lit(2**62)).otherwise(F.floor(kept))


def _running(hist: DataFrame, scope: list[str], by: str) -> Column:
    """The count before each entry of a histogram, inside its scope."""
    return F.sum("_c").over(Window.partitionBy(*scope).orderBy(by)) - F.col("_c")


def order_stats(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranks: dict[str, Rank],
    width: float = BUCKET_WIDTH,
    finer: Sequence[float] = (),
) -> DataFrame:
    """Per group: n and the values at the given zero-based ranks.

    `finer` are narrower bucket widths for groups that may hold much of the
    table; each adds a pass over the values of the chosen buckets. Results do
    not depend on any width.
    """
    values = df.select(*keys, value).filter(F.col(value).isNotNull()).withColumn("_c", F.lit(1))
    if finer:  # large groups repeat values, small ones hardly do and count them once a bucket is chosen
        values = values.groupBy(*keys, value).agg(F.sum("_c").alias("_c"))
    facts, scope = [], list(keys)
    for level, size in enumerate((width, *finer)):
        by = f"_b{level}"
        values = values.withColumn(by, _bucket(value, size))
        hist = values.groupBy(*scope, by).agg(F.sum("_c").alias("_c"), *[F.first(c).alias(c) for c in facts])
        before = _running(hist, scope, by)
        if level:
            hist = hist.withColumn("_before", F.col("_skip") + before)
        else:
            hist = hist.withColumns({"_before": before, "_n": F.sum("_c").over(Window.partitionBy(*scope))})
            picks = [F.struct(F.lit(name).alias("pick"), rank(F.col("_n")).alias("rank")) for name, rank in ranks.items()]
            hist = hist.withColumn("_picks", F.array(*picks))
        inside = F.filter("_picks", lambda p: (p["rank"] >= F.col("_before")) & (p["rank"] < F.col("_before") + F.col("_c")))
        # the buckets that hold a rank: at most one row per group and rank
        wanted = hist.withColumn("_picks", inside).filter(F.size("_picks") > 0)
        wanted = wanted.select(*scope, by, "_n", F.col("_before").alias("_skip"), "_picks")
        # groups with a null key are groups too
        scope = [*scope, by]
        same = [F.col(f"v.{k}").eqNullSafe(F.col(f"w.{k}")) for k in scope]
        facts = ["_n", "_skip", "_picks"]  # the same for all values of a bucket
        values = values.drop(*facts).alias("v").join(wanted.alias("w"), same)
        values = values.select(*[F.col(f"v.{k}").alias(k) for k in scope], value, "_c", *facts)
    if not finer:
        values = values.groupBy(*scope, value).agg(F.sum("_c").alias("_c"), *[F.first(c).alias(c) for c in facts])
    placed = values.withColumn("_at", F.col("_skip") + _running(values, scope, value))
    found = placed.withColumn("_p", F.explode("_picks")).filter("_p.rank >= _at AND _p.rank < _at + _c")
    return found.groupBy(*keys).agg(
        F.max("_n").alias("n"), *[F.max(F.when(F.col("_p.pick") == name, F.col(value))).alias(name) for name in ranks]
    )


def exact_median(
    df: DataFrame, keys: list[str], value: str, name: str, width: float = BUCKET_WIDTH, finer: Sequence[float] = ()
) -> DataFrame:
    """Per group: the exact median under `name`, and n."""
    middles = order_stats(df, keys, value, {"_lo": lower_middle, "_hi": upper_middle}, width, finer)
    return middles.select(*keys, ((F.col("_lo") + F.col("_hi")) / 2).alias(name), "n")
