"""Day quality: poll outcomes, gaps, coverage, and checks of city parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrain.functions.clock import day_end, day_start
from fleetgrain.operators import ranks
from fleetgrain.operators.sequences import lag_in_buckets
from fleetgrain.params import GAP_MULTIPLIER, HEARTBEAT_PARTIAL_SEC
from fleetgrain.session import cut_lineage

BUCKET_SEC = 900  # slice of time one window task sorts


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def poll_outcomes(polls: DataFrame) -> DataFrame:
    """Per day: polls logged, ok, empty, failed, and the bounding-box sums."""
    ok = F.col("fetch_ok")
    out = polls.groupBy("service_date").agg(
        F.count(F.lit(1)).alias("polls_logged"),
        F.count_if(ok).alias("successful_polls"),
        F.count_if(ok & (F.col("vehicle_count") == 0)).alias("empty_polls"),
        F.count_if(~ok).alias("fetch_error_polls"),
        _total("entities_total").alias("entities_total"),
        _total("vehicles_with_position").alias("vehicles_with_position"),
        _total("dropped_out_of_bbox").alias("dropped_out_of_bbox"),
    )
    share = 100.0 * F.col("dropped_out_of_bbox") / F.nullif(F.col("vehicles_with_position"), F.lit(0))
    return out.withColumn("dropped_out_of_bbox_pct", F.bround(share, 3))


def day_windows(days: DataFrame, tz, now: Column) -> DataFrame:
    """Local midnight to local midnight, cut at `now` (epoch seconds) while the day runs."""
    end = day_end(F.col("service_date"), tz)
    return days.select(
        "service_date",
        day_start(F.col("service_date"), tz).alias("start_ts"),
        F.least(end, now).alias("end_ts"),
        (now < end).alias("day_in_progress"),
    )


def poll_times(polls: DataFrame, positions: DataFrame) -> DataFrame:
    """The stamps a day is judged by, with `heartbeat_partial`.

    Every heartbeat counts, repeats included. Where the heartbeat starts late,
    the data's own distinct stamps before it are added; where there is none,
    the data's distinct stamps stand alone and the flag is null.
    """
    data = positions.select("service_date", "snapshot_ts").distinct()
    beats = polls.select("service_date", "snapshot_ts")
    first_beat = beats.groupBy("service_date").agg(F.min("snapshot_ts").alias("first_beat"))
    first_data = data.groupBy("service_date").agg(F.min("snapshot_ts").alias("first_data"))
    starts = first_beat.join(first_data, "service_date", "full_outer").select(
        "service_date",
        "first_beat",
        F.when(
            F.col("first_beat").isNotNull(),
            F.coalesce(F.col("first_beat") - F.col("first_data") > HEARTBEAT_PARTIAL_SEC, F.lit(False)),
        ).alias("heartbeat_partial"),
    )
    starts = F.broadcast(starts)  # one row per calendar day
    early = data.join(starts, "service_date").filter(
        F.col("first_beat").isNull()
        | (F.col("heartbeat_partial") & (F.col("snapshot_ts") < F.col("first_beat")))
    )
    # a partial heartbeat is merged as a set, a whole one keeps its repeats
    kept = beats.groupBy("service_date", "snapshot_ts").agg(F.count(F.lit(1)).alias("polls")).join(
        starts, "service_date"
    ).withColumn("polls", F.when(F.col("heartbeat_partial"), F.lit(1)).otherwise(F.col("polls")))
    columns = ["service_date", "snapshot_ts", "polls", "heartbeat_partial"]
    return kept.select(*columns).unionByName(early.withColumn("polls", F.lit(1)).select(*columns))


def stamps(times: DataFrame) -> DataFrame:
    """Distinct stamps with their poll count. Repeats make zero-length steps only."""
    if "polls" in times.columns:
        return times.select("service_date", "snapshot_ts", "polls")
    return times.groupBy("service_date", "snapshot_ts").agg(F.count(F.lit(1)).alias("polls"))


def _windowed(times: DataFrame, windows: DataFrame, interval_sec: float) -> DataFrame:
    """Day windows with the last stamp; a running day ends one interval past it."""
    last = stamps(times).groupBy("service_date").agg(
        F.min("snapshot_ts").alias("first_ts"),
        F.max("snapshot_ts").alias("last_ts"),
        F.sum("polls").alias("polls"),
    )
    joined = windows.join(last, "service_date", "left")
    trims = F.col("day_in_progress") & F.col("last_ts").isNotNull()
    return joined.select(
        "service_date",
        "start_ts",
        "first_ts",
        "last_ts",
        "day_in_progress",
        F.coalesce("polls", F.lit(0)).alias("polls"),
        F.when(trims, F.col("end_ts") - F.col("last_ts")).alias("local_lag_sec"),
        F.when(trims, F.col("last_ts") + interval_sec).otherwise(F.col("end_ts")).cast("bigint").alias("end_ts"),
    )


def _steps(times: DataFrame) -> DataFrame:
    """Distinct stamps of a day with the stamp before, null on the first."""
    return lag_in_buckets(
        stamps(times),
        ["service_date"],
        ["snapshot_ts"],
        F.floor(F.col("snapshot_ts") / BUCKET_SEC),
        {"after_ts": F.col("snapshot_ts")},
    )


def poll_gaps(
    times: DataFrame, windows: DataFrame, interval_sec: float, multiplier: float = GAP_MULTIPLIER
) -> DataFrame:
    """Silences strictly longer than the threshold, the day's edges included."""
    inner = _steps(times).select(
        "service_date", "after_ts", F.col("snapshot_ts").alias("before_ts")
    )
    days = _windowed(times, windows, interval_sec)
    head = F.struct(F.col("start_ts").alias("after_ts"), F.coalesce("first_ts", "end_ts").alias("before_ts"))
    tail = F.struct(F.col("last_ts").alias("after_ts"), F.col("end_ts").alias("before_ts"))
    edges = days.select("service_date", F.explode(F.array(head, tail)).alias("e"))
    edges = edges.select("service_date", "e.after_ts", "e.before_ts")
    seconds = F.col("before_ts") - F.col("after_ts")
    return (
        inner.unionByName(edges)
        .withColumn("gap_seconds", seconds)
        .filter(F.col("gap_seconds") > interval_sec * multiplier)
    )


def observed_interval(times: DataFrame) -> DataFrame:
    """Median step between consecutive stamps; null under two stamps.

    A stamp repeated k times adds k - 1 steps of zero, so steps carry weights
    and the median is read off a histogram of whole seconds.
    """
    parts = F.array(
        F.struct((F.col("snapshot_ts") - F.col("after_ts")).alias("step"), F.lit(1).cast("bigint").alias("w")),
        F.struct(F.lit(0).cast("bigint").alias("step"), (F.col("polls") - 1).cast("bigint").alias("w")),
    )
    weighted = (
        _steps(times)
        .select("service_date", F.explode(parts).alias("p"))
        .select("service_date", "p.step", "p.w")
        .filter("step IS NOT NULL AND w > 0")
        .groupBy("service_date", "step")
        .agg(F.sum("w").alias("w"))
    )
    medians = weighted.groupBy("service_date").agg(
        F.percentile("step", F.lit(0.5), F.col("w")).alias("observed_interval_sec")
    )
    return times.select("service_date").distinct().join(medians, "service_date", "left")


def coverage(times: DataFrame, windows: DataFrame, interval_sec: float) -> DataFrame:
    """Expected polls and coverage per day of `windows`."""
    days = _windowed(times, windows, interval_sec)
    seconds = F.col("end_ts") - F.col("start_ts")
    expected = F.when(seconds > 0, seconds / F.lit(float(interval_sec)))
    return days.select(
        "service_date",
        "day_in_progress",
        "polls",
        "local_lag_sec",
        seconds.alias("day_seconds"),
        F.bround(expected, 1).alias("expected_polls"),
        F.bround(100.0 * F.col("polls") / expected, 2).alias("coverage_pct"),
    )


def day_manifests(
    positions: DataFrame,
    polls: DataFrame,
    files: DataFrame,
    tz,
    now: Column,
    interval_sec: float,
    multiplier: float = GAP_MULTIPLIER,
) -> DataFrame:
    """The quality record of every listed day in one pass, ready to write by service_date.

    `files` has a row per day file: service_date and what the record says of
    the files themselves. A day whose file holds no record has a record too.
    """
    # positions are read once, down to one row per poll; all that follows starts from these tables
    per_poll = cut_lineage(
        positions.groupBy("service_date", "snapshot_ts").agg(F.count(F.lit(1)).alias("records"))
    )
    days = files.join(
        per_poll.groupBy("service_date").agg(F.sum("records").alias("total_vehicle_records")), "service_date", "left"
    ).fillna(0, ["total_vehicle_records"])
    windows = day_windows(days, tz, now)
    times = cut_lineage(poll_times(polls, per_poll))
    gaps = poll_gaps(times, windows, interval_sec, multiplier).groupBy("service_date").agg(
        F.sort_array(F.collect_list(F.struct("after_ts", "before_ts", "gap_seconds"))).alias("gaps")
    )
    partial = times.groupBy("service_date").agg(F.bool_or("heartbeat_partial").alias("heartbeat_partial"))
    out = days
    for part in (
        coverage(times, windows, interval_sec),
        gaps,
        partial,
        poll_outcomes(polls),
        observed_interval(times),
    ):
        out = out.join(part, "service_date", "left")
    none = F.array().cast(gaps.schema["gaps"].dataType)
    return out.withColumn("gaps", F.coalesce("gaps", none)).withColumn("gap_count", F.size("gaps"))


def city_violations(cities: DataFrame) -> DataFrame:
    """(slug, problem) for every broken rule of the city parameters."""

    def rule(broken: Column, text: str) -> Column:
        return F.when(F.coalesce(broken, F.lit(True)), F.lit(text))

    rules = [
        rule(~(F.col("lat_min") < F.col("lat_max")), "latitude edges out of order"),
        rule(~(F.col("lon_min") < F.col("lon_max")), "longitude edges out of order"),
        rule(~F.col("speed_field_unit").isin("kmh", "ms"), "unknown speed field unit"),
        rule(F.col("timezone").isNull() | (F.col("timezone") == ""), "no timezone"),
        rule(~(F.col("poll_interval_sec") > 0), "no poll interval"),
        rule(F.coalesce(F.col("positions_feed"), F.lit("")) == "", "no vehicle positions feed"),
        rule(F.coalesce(F.col("static_feed"), F.lit("")) == "", "no static feed"),
        rule(F.coalesce(F.col("licence"), F.lit("")) == "", "no licence"),
    ]
    problems = F.filter(F.array(*rules), lambda p: p.isNotNull())
    return cities.select("slug", F.explode(problems).alias("problem"))
