"""Previous-row lookups that do not put a whole key into one task.

A plain `lag` over a key sorts the key's rows in one task. Here rows are
windowed per (key, bucket), the bucket being a coarse slice of the order
column, and the first row of a bucket takes its value from the last row of
the nearest earlier bucket. Those last rows are one per (key, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lag_in_buckets(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    bucket: Column,
    values: dict[str, Column],
) -> DataFrame:
    """Add one column per entry of `values`: that expression on the previous row.

    Keys and bucket must not be null; the bucket must not fall while the order rises.
    """
    spot = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[v.alias(k) for k, v in values.items()])
    rows = df.withColumn("_bucket", bucket).withColumn("_payload", payload)
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    rows = rows.withColumn("_prev", F.lag("_payload").over(within)).withColumn(
        "_first", F.row_number().over(within) == 1
    )
    ends = rows.groupBy(*keys, "_bucket").agg(F.max_by("_payload", spot).alias("_end"))
    across = Window.partitionBy(*keys).orderBy("_bucket")
    carried = ends.select(*keys, "_bucket", F.lag("_end").over(across).alias("_carried"))
    joined = rows.join(carried, [*keys, "_bucket"])
    prev = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_prev"))
    out = joined.withColumn("_prev", prev)
    for name in values:
        out = out.withColumn(name, F.col(f"_prev.{name}"))
    return out.drop("_bucket", "_payload", "_prev", "_first", "_carried")


def running_sum_in_buckets(
    df: DataFrame, keys: list[str], order: list[str], bucket: Column, amount: Column, name: str
) -> DataFrame:
    """Running sum (inclusive) per key, windowed per bucket plus bucket offsets."""
    rows = df.withColumn("_bucket", bucket).withColumn("_amount", amount)
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = rows.withColumn("_part", F.sum("_amount").over(within))
    totals = rows.groupBy(*keys, "_bucket").agg(F.sum("_amount").alias("_total"))
    # an empty key list leaves one row per bucket, a set the caller keeps small
    span = Window.partitionBy(*keys).orderBy("_bucket") if keys else Window.orderBy("_bucket")
    before = F.sum("_total").over(span) - F.col("_total")
    offsets = totals.select(*keys, "_bucket", before.alias("_before"))
    return (
        rows.join(offsets, [*keys, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_part"))
        .drop("_bucket", "_amount", "_part", "_before")
    )
