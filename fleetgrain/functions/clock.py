"""Local time slots, day windows and hour keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrain.params import TIMESLOT_MINUTES

SLOTS_PER_DAY = 24 * 60 // TIMESLOT_MINUTES


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def local_time(epoch_sec: Column, tz) -> Column:
    return F.from_utc_timestamp(F.timestamp_seconds(epoch_sec), tz)


def local_date(epoch_sec: Column, tz) -> Column:
    return F.to_date(local_time(epoch_sec, tz))


def timeslot(epoch_sec: Column, tz) -> Column:
    """Start of the local quarter hour, HH:MM."""
    local = local_time(epoch_sec, tz)
    minute = (F.floor(F.minute(local) / TIMESLOT_MINUTES) * TIMESLOT_MINUTES).cast("int")
    return F.concat(_two(F.hour(local)), F.lit(":"), _two(minute))


def slot_label(slot_no: Column) -> Column:
    minutes = slot_no.cast("int") * TIMESLOT_MINUTES
    hour = F.floor(minutes / 60).cast("int")
    return F.concat(_two(hour), F.lit(":"), _two(minutes - hour * 60))


def slot_number(label: Column) -> Column:
    return (
        F.substring(label, 1, 2).cast("int") * 60 + F.substring(label, 4, 2).cast("int")
    ) / TIMESLOT_MINUTES


def slot_spine(spark: SparkSession) -> DataFrame:
    """The day's 96 slot labels in order."""
    return spark.range(SLOTS_PER_DAY).select(
        F.col("id").cast("int").alias("slot_no"), slot_label(F.col("id")).alias("timeslot")
    )


def date_in(name: Column, pattern: str) -> Column:
    """The date that a pattern's first group finds in a name; null for none and for days no calendar has."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")), F.lit("yyyy-MM-dd")).cast("date")


def day_start(date: Column, tz) -> Column:
    """Epoch second of local midnight."""
    return F.unix_timestamp(F.to_utc_timestamp(date.cast("timestamp"), tz))


def day_end(date: Column, tz) -> Column:
    return day_start(F.date_add(date, 1), tz)


def is_weekday(date: Column) -> Column:
    return F.weekday(date) < 5


def hour_key(ts: Column) -> Column:
    return F.date_format(F.date_trunc("hour", ts), "yyyy-MM-dd'T'HH")


def hour_of_name(name: Column) -> Column:
    """UTC hour key inside a snapshot file name, null when it has another form."""
    # Fixed value: how trip-update snapshots are named.
    pattern = r"^tu_(\d{4}-\d\d-\d\dT\d\d)\d{4}Z\.pb(?:\.tmp)?$"
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
