"""Change capture and closed-hour compaction over streams.

All run the batch operators on each micro-batch. Alert capture carries two rows
of memory per network between batches, static capture one; compaction carries
the archive itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgrain.operators import capture
from fleetgrain.sinks import append_runs, overwrite_partitions
from fleetgrain.streaming.state import BatchState

_MEMORY = "city STRING, last_digest STRING, last_items BIGINT, ran BOOLEAN"


def start_capture(
    runs: DataFrame, out: str, checkpoint: str, order: list[str], bucket: Callable[[], Column], trigger: dict
) -> StreamingQuery:
    """Log every run, marked kept or not, equal to `capture_alerts` over all of them.

    `runs` has (city, order columns, digest, items, accepted); batches must
    arrive in order, rows inside one need not.
    """
    spark = runs.sparkSession
    memory = BatchState(spark, f"{out}/memory", _MEMORY)

    def keep(batch: DataFrame, batch_id: int) -> None:
        before = memory.before(batch_id)
        judged = _with_memory(batch, before, order, bucket())
        append_runs(judged, f"{out}/runs", batch_id)
        done = spark.read.parquet(f"{out}/runs").filter(F.col("batch") == batch_id)
        memory.save(_next_memory(done, before, order), batch_id)

    return (
        runs.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _with_memory(batch: DataFrame, before: DataFrame, order: list[str], bucket: Column) -> DataFrame:
    """Judge a batch that goes on from remembered runs.

    The memory is replayed as up to two runs ahead of the batch: a counted one
    with the last kept digest, then one with the last run's count.
    """
    lead = {c: batch.schema[c].dataType for c in order}
    kept = before.filter("last_digest IS NOT NULL").select(
        "city", F.lit(0).alias("_turn"), F.col("last_digest").alias("digest"), F.lit(1).cast("bigint").alias("items"),
        F.lit(True).alias("accepted"),
    )
    last = before.filter("ran").select(
        "city", F.lit(1).alias("_turn"), F.lit(None).cast("string").alias("digest"),
        # a count above zero would count as a change, so only zero is replayed as accepted
        F.lit(0).cast("bigint").alias("items"), (F.col("last_items") == 0).alias("accepted"),
    )
    replay = kept.unionByName(last)
    for name, kind in lead.items():
        replay = replay.withColumn(name, F.lit(None).cast(kind))
    rows = batch.withColumn("_turn", F.lit(2)).unionByName(
        replay.select(*batch.columns, "_turn")
    )
    first = F.lit(-(2**62)).cast("bigint")  # replayed runs sit before every bucket
    spot = F.when(F.col("_turn") == 2, bucket).otherwise(first)
    judged = capture.capture_alerts(rows, ["city"], ["_turn", *order], spot)
    return judged.filter("_turn = 2").drop("_turn")


def _next_memory(done: DataFrame, before: DataFrame, order: list[str]) -> DataFrame:
    spot = F.struct(*[F.col(c) for c in order])
    fresh = done.groupBy("city").agg(
        F.max_by(F.when(F.col("kept"), F.col("digest")), F.when(F.col("kept"), spot)).alias("_digest"),
        F.max_by(F.when(F.col("accepted"), F.col("items")), spot).alias("_items"),
    )
    merged = before.join(fresh.withColumn("_now", F.lit(True)), "city", "full_outer")
    return merged.select(
        "city",
        F.coalesce("_digest", "last_digest").alias("last_digest"),
        F.when(F.col("_now"), F.col("_items")).otherwise(F.col("last_items")).alias("last_items"),
        F.lit(True).alias("ran"),
    )


_STATIC_MEMORY = "city STRING, last_digest STRING, day DATE, named BIGINT"


def start_static_capture(
    runs: DataFrame,
    out: str,
    checkpoint: str,
    order: list[str],
    bucket: Callable[[], Column],
    local_ts: Callable[[], Column],
    trigger: dict,
) -> StreamingQuery:
    """Keep static feeds that differ from the one before and name them, equal to the batch form over all runs.

    `runs` has (city, order columns, digest); batches must arrive in order, rows
    inside one need not. A network's memory is one row: the newest digest, the
    newest local day with a kept feed and how many were named on it. A batch with
    a later day starts that day's numbers anew. `out`/static gets the kept runs
    with `day` and `snapshot`; a repeated batch replaces its own.
    """
    spark = runs.sparkSession
    memory = BatchState(spark, f"{out}/memory", _STATIC_MEMORY)

    def keep(batch: DataFrame, batch_id: int) -> None:
        before = memory.before(batch_id)
        # the newest digest is replayed ahead of the batch
        replay = before.select("city", F.lit(0).alias("_turn"), F.col("last_digest").alias("digest"))
        rows = batch.withColumn("_turn", F.lit(1)).unionByName(replay, allowMissingColumns=True)
        spot = F.when(F.col("_turn") == 1, bucket()).otherwise(F.lit(-(2**62)).cast("bigint"))
        changed = capture.keep_changes(rows, ["city"], ["_turn", *order], spot).filter("kept AND _turn = 1")
        kept = changed.drop("kept", "_turn").withColumn("day", F.to_date(local_ts()))
        named = capture.name_snapshots(kept, ["city"], order, local_ts(), before.select("city", "day", "named"))
        append_runs(named, f"{out}/static", batch_id)
        done = spark.read.parquet(f"{out}/static").filter(F.col("batch") == batch_id)
        memory.save(_next_static_memory(done, before, order), batch_id)

    return (
        runs.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _next_static_memory(done: DataFrame, before: DataFrame, order: list[str]) -> DataFrame:
    """The newest digest and day of each network, with the number of names given on that day."""
    newest = F.struct(*[F.col(c) for c in order])
    by_day = done.groupBy("city", "day").agg(
        F.max(F.struct(newest.alias("spot"), F.col("digest"))).alias("end"), F.count(F.lit(1)).alias("n")
    )
    fresh = by_day.groupBy("city").agg(F.max(F.struct("day", "end", "n")).alias("now"))
    merged = before.join(fresh, "city", "full_outer")
    same_day = F.when(F.col("now.day") == F.col("day"), F.col("named")).otherwise(F.lit(0))
    return merged.select(
        "city",
        F.when(F.col("now").isNotNull(), F.col("now.end.digest")).otherwise(F.col("last_digest")).alias("last_digest"),
        F.coalesce("now.day", "day").alias("day"),
        F.when(F.col("now").isNotNull(), same_day + F.col("now.n")).otherwise(F.col("named")).alias("named"),
    )


def start_compaction(
    incoming: DataFrame, out: str, checkpoint: str, now: Callable[[], Column], trigger: dict
) -> StreamingQuery:
    """Merge incoming (name, sha256) files of closed hours into `out`/archive by hour.

    Files of open hours and conflicts wait in `out`/waiting and are tried again
    with the next batch. A repeated batch finds its files already held.
    """
    spark = incoming.sparkSession
    waiting = BatchState(spark, f"{out}/waiting", "name STRING, sha256 STRING")
    schema = "name STRING, sha256 STRING, hour STRING"

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("name", "sha256").unionByName(waiting.before(batch_id)).distinct()
        archive = _existing(spark, f"{out}/archive", schema)
        compared = capture.compare_incoming(archive, capture.closed_incoming(rows, now()))
        # settle fates before the archive moves: they are re-read below
        append_runs(compared, f"{out}/fates", batch_id)
        fates = spark.read.parquet(f"{out}/fates").filter(F.col("batch") == batch_id).drop("batch")
        overwrite_partitions(
            capture.merge_hours(archive, fates).select("name", "sha256", "hour"), f"{out}/archive", ["hour"]
        )
        waiting.save(capture.leftovers(rows, fates), batch_id)

    return (
        incoming.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _existing(spark, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
