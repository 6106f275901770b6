"""Change capture over a log of responses, and closed-hour compaction.

Batch form; `streaming.capture` gives the same rows from a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrain.functions.clock import hour_key, hour_of_name
from fleetgrain.operators.sequences import lag_in_buckets, running_sum_in_buckets


def capture_alerts(runs: DataFrame, keys: list[str], order: list[str], bucket: Column) -> DataFrame:
    """Mark the responses to keep.

    `runs` has (keys, order, digest, items, accepted). A response is kept when
    its digest differs from the last kept one. An empty response counts only
    when the run before it, of any kind, was accepted and empty too; a refused
    run leaves no count behind. A response that counts but is not kept equals
    the last kept one, so "last kept" is the digest of the previous response
    that counts, and two lags answer what looks like a fold.
    """
    seen = F.when(F.col("accepted"), F.col("items"))
    runs = lag_in_buckets(runs, keys, order, bucket, {"_items_before": seen})
    counts = F.col("accepted") & (
        (F.col("items") > 0) | F.coalesce(F.col("_items_before") == 0, F.lit(False))
    )
    runs = runs.withColumn("counts", F.coalesce(counts, F.lit(False))).drop("_items_before")
    judged = keep_changes(runs.filter("counts"), keys, order, bucket)
    rest = runs.filter(~F.col("counts")).withColumn("kept", F.lit(False))
    return judged.unionByName(rest).drop("counts")


def keep_changes(runs: DataFrame, keys: list[str], order: list[str], bucket: Column) -> DataFrame:
    """Add `kept`: the digest differs from the previous row's; A, B, A keeps all three."""
    out = lag_in_buckets(runs, keys, order, bucket, {"_before": F.col("digest")})
    return out.withColumn("kept", ~F.col("digest").eqNullSafe(F.col("_before"))).drop("_before")


def name_snapshots(
    kept: DataFrame, keys: list[str], order: list[str], local_ts: Column, named_before: DataFrame | None = None
) -> DataFrame:
    """File names of kept static feeds: plain for a local day's first, with the clock after.

    `named_before` (keys, day, named) counts feeds of a day that were named earlier; one row per key and day.
    """
    rows = kept.withColumn("_local", local_ts).withColumn("_date", F.to_date("_local"))
    numbered = running_sum_in_buckets(
        rows, [*keys, "_date"], order, F.hour("_local"), F.lit(1), "_nth"
    )
    if named_before is not None:
        earlier = named_before.select(*keys, F.col("day").alias("_date"), F.col("named").alias("_named"))
        numbered = numbered.join(earlier, [*keys, "_date"], "left").withColumn(
            "_nth", F.col("_nth") + F.coalesce("_named", F.lit(0))
        ).drop("_named")
    date = F.date_format("_local", "yyyy-MM-dd")
    name = F.when(F.col("_nth") == 1, F.concat(F.lit("gtfs_"), date, F.lit(".zip"))).otherwise(
        F.concat(F.lit("gtfs_"), date, F.lit("T"), F.date_format("_local", "HHmm"), F.lit(".zip"))
    )
    return numbered.withColumn("snapshot", name).drop("_local", "_date", "_nth")


def closed_incoming(incoming: DataFrame, now: Column) -> DataFrame:
    """Incoming (name, sha256) rows of hours before the current one, with their hour."""
    return incoming.withColumn("hour", hour_of_name(F.col("name"))).filter(F.col("hour") < hour_key(now))


def compare_incoming(archive: DataFrame, closed: DataFrame) -> DataFrame:
    """Add `fate`: new joins its hour, same is dropped, conflict is left and reported."""
    held = archive.select("hour", "name", F.col("sha256").alias("_held"))
    fate = (
        F.when(F.col("_held").isNull(), "new")
        .when(F.col("_held") == F.col("sha256"), "same")
        .otherwise("conflict")
    )
    return closed.join(held, ["hour", "name"], "left").withColumn("fate", fate).drop("_held")


def merge_hours(archive: DataFrame, compared: DataFrame) -> DataFrame:
    """The hours that gain files, whole: what a dynamic overwrite by hour writes."""
    new = compared.filter(F.col("fate") == "new")
    touched = new.select("hour").distinct()
    kept = archive.join(touched, "hour", "left_semi")
    return kept.unionByName(new.select(*archive.columns))


def leftovers(incoming: DataFrame, compared: DataFrame) -> DataFrame:
    """Incoming rows that stay: open hours, foreign names and conflicts."""
    gone = compared.filter(F.col("fate") != "conflict").select("name")
    return incoming.join(gone, "name", "left_anti")


def hour_completeness(archive: DataFrame, interval_sec: int) -> DataFrame:
    """Per hour: files held, and whether at least half the expected ones are."""
    return archive.groupBy("hour").agg(F.count(F.lit(1)).alias("files")).withColumn(
        "half_full", F.col("files") * 2 >= 3600 // interval_sec
    )
