"""Time-of-day analysis of one period's bins, and of two periods against each other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgrain.functions.clock import slot_number
from fleetgrain.operators import ranks
from fleetgrain.params import (
    CORE_WINDOW,
    DAY_WINDOW,
    EVENING_PEAK,
    KMH_PER_MS,
    MIDDAY,
    MIN_SAMPLES,
    MORNING_PEAK,
    NIGHT_WINDOW,
    PERSISTENCE_CUTS_KMH,
    SOLID_MIN_SEGMENTS,
)

SEGMENT = ["period_key", "shape_key", "segment_index"]
Spec = str | tuple[str, str]  # one slot label, or an inclusive window of labels


@dataclass(frozen=True)
class Comparison:
    label: str
    first: Spec
    second: Spec


COMPARISONS = (
    Comparison("morning peak vs midday", MORNING_PEAK, MIDDAY),
    Comparison("evening peak vs midday", EVENING_PEAK, MIDDAY),
    Comparison("evening peak vs morning peak", EVENING_PEAK, MORNING_PEAK),
    Comparison("night vs day", NIGHT_WINDOW, DAY_WINDOW),
)
AGAINST_SPECS: tuple[Spec, ...] = (
    *(f"{hour:02d}:00" for hour in range(7, 20)),
    EVENING_PEAK,
    DAY_WINDOW,
    NIGHT_WINDOW,
)


def spec_label(spec: Spec) -> str:
    return spec if isinstance(spec, str) else f"{spec[0]}-{spec[1]}"


def segment_table(bins: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Long (period, segment, timeslot, kmh) table of the bins thick enough."""
    return bins.filter(F.col("n_samples") >= min_samples).select(
        *SEGMENT, "timeslot", (F.col("median_speed_ms") * KMH_PER_MS).alias("kmh")
    )


def network_profile(by_segment: DataFrame) -> DataFrame:
    """Median over segments and their count, per period and slot."""
    out = ranks.exact_median(by_segment, ["period_key", "timeslot"], "kmh", "median_kmh")
    return out.withColumnRenamed("n", "segments")


def core_extremes(profile: DataFrame, window: tuple[str, str] = CORE_WINDOW) -> DataFrame:
    """Slowest and fastest slot inside the window, the earlier slot on a tie."""
    inside = profile.filter(F.col("timeslot").between(*window))
    slot = F.col("timeslot")
    return inside.groupBy("period_key").agg(
        F.min("median_kmh").alias("lowest_kmh"),
        F.min_by(slot, F.struct("median_kmh", "timeslot")).alias("lowest_slot"),
        F.max("median_kmh").alias("highest_kmh"),
        F.max_by(slot, F.struct(F.col("median_kmh"), -slot_number(slot))).alias("highest_slot"),
    ).withColumn("range_kmh", F.col("highest_kmh") - F.col("lowest_kmh"))


def _at(spec: Spec, extra: Column | None = None) -> Column:
    """Aggregate giving a segment's value at a slot, or its median over a window."""
    slot = F.col("timeslot")
    hit = slot == spec if isinstance(spec, str) else slot.between(*spec)
    if extra is not None:
        hit = hit & extra
    kept = F.when(hit, F.col("kmh"))
    return F.max(kept) if isinstance(spec, str) else F.median(kept)


def _pairs(values: DataFrame, names: list[tuple[str, Column, Column]], keys: list[str]) -> DataFrame:
    """Long (keys, label, a, b) of the segments carrying both sides."""
    cells = F.array(*[F.struct(F.lit(n).alias("label"), a.alias("a"), b.alias("b")) for n, a, b in names])
    return (
        values.select(*keys, F.explode(cells).alias("p"))
        .select(*keys, "p.label", "p.a", "p.b")
        .filter("a IS NOT NULL AND b IS NOT NULL")
    )


def _paired_stats(pairs: DataFrame, keys: list[str]) -> DataFrame:
    groups = [*keys, "label"]
    moved = (F.col("a") != 0) & (F.col("b") != 0)
    totals = pairs.groupBy(*groups).agg(
        F.count_if(moved).alias("n"),
        F.count_if(~moved).alias("zeroes"),
        F.count_if(moved & (F.col("a") < F.col("b"))).alias("_slower"),
    )
    diffs = pairs.filter(moved).withColumn("diff", F.col("a") - F.col("b"))
    picks = {
        "_lo": ranks.lower_middle,
        "_hi": ranks.upper_middle,
        "iqr_low": ranks.lower_quarter,
        "iqr_high": ranks.upper_quarter,
    }
    placed = ranks.order_stats(diffs, groups, "diff", picks).drop("n")
    return totals.join(placed, groups, "left").select(
        *groups,
        "n",
        "zeroes",
        ((F.col("_lo") + F.col("_hi")) / 2).alias("median_diff"),
        (F.col("_slower") / F.nullif(F.col("n"), F.lit(0))).alias("share_a_slower"),
        "iqr_low",
        "iqr_high",
    )


def paired(
    by_segment: DataFrame,
    comparisons: tuple[Comparison, ...] = COMPARISONS,
) -> DataFrame:
    """Same-segment comparisons. All sides come from one pass, not self joins."""
    specs = sorted({s for c in comparisons for s in (c.first, c.second)}, key=spec_label)
    names = {spec: f"s{i}" for i, spec in enumerate(specs)}
    values = by_segment.groupBy(*SEGMENT).agg(*[_at(s).alias(n) for s, n in names.items()])
    sides = [(c.label, F.col(names[c.first]), F.col(names[c.second])) for c in comparisons]
    return _paired_stats(_pairs(values, sides, ["period_key"]), ["period_key"])


def against(
    by_segment: DataFrame,
    later: str,
    earlier: str,
    specs: tuple[Spec, ...] = AGAINST_SPECS,
) -> DataFrame:
    """Later minus earlier period on the same segment at the same time of day."""
    two = by_segment.filter(F.col("period_key").isin(later, earlier))
    is_later = F.col("period_key") == later
    values = two.groupBy("shape_key", "segment_index").agg(
        *[
            side.alias(f"{tag}{i}")
            for i, spec in enumerate(specs)
            for tag, side in (("a", _at(spec, is_later)), ("b", _at(spec, ~is_later)))
        ]
    )
    sides = [(spec_label(s), F.col(f"a{i}"), F.col(f"b{i}")) for i, s in enumerate(specs)]
    return _paired_stats(_pairs(values, sides, []), [])


def common_segments(by_segment: DataFrame, later: str, earlier: str) -> DataFrame:
    """Segments of each of two periods and in both, one row."""
    seen = (
        by_segment.filter(F.col("period_key").isin(later, earlier))
        .groupBy("shape_key", "segment_index")
        .agg(
            F.bool_or(F.col("period_key") == later).alias("a"),
            F.bool_or(F.col("period_key") == earlier).alias("b"),
        )
    )
    return seen.agg(
        F.count_if("a").alias("later_segments"),
        F.count_if("b").alias("earlier_segments"),
        F.count_if(F.col("a") & F.col("b")).alias("in_both"),
    )


def persistence(
    by_segment: DataFrame,
    cuts: tuple[float, ...] = PERSISTENCE_CUTS_KMH,
    first: str = MORNING_PEAK,
    second: str = MIDDAY,
) -> DataFrame:
    """Of the segments under each cut at the first slot, how many still are at the second."""
    values = by_segment.groupBy(*SEGMENT).agg(_at(first).alias("a"), _at(second).alias("b"))
    both = values.filter("a IS NOT NULL AND b IS NOT NULL")
    moved = (F.col("a") != 0) & (F.col("b") != 0)
    cells = F.array(*[F.lit(float(c)) for c in cuts])
    slow = moved & (F.col("a") < F.col("cut_kmh"))
    out = (
        both.withColumn("cut_kmh", F.explode(cells))
        .groupBy("period_key", "cut_kmh")
        .agg(
            F.count_if(moved).alias("population"),
            F.count_if(~moved).alias("zeroes"),
            F.count_if(slow).alias("slow_at_a"),
            F.count_if(slow & (F.col("b") < F.col("cut_kmh"))).alias("still_slow"),
        )
    )
    return out.withColumn("share", F.col("still_slow") / F.greatest(F.col("slow_at_a"), F.lit(1)))


def window_medians(by_segment: DataFrame, windows: dict[str, tuple[str, str]]) -> DataFrame:
    return by_segment.groupBy(*SEGMENT).agg(*[_at(w).alias(n) for n, w in windows.items()])


def populations(
    by_segment: DataFrame,
    day: tuple[str, str] = DAY_WINDOW,
    night: tuple[str, str] = NIGHT_WINDOW,
) -> DataFrame:
    """Segments observed in the day and in the night window, per period."""
    slot = F.col("timeslot")
    seen = by_segment.groupBy(*SEGMENT).agg(
        F.bool_or(slot.between(*day)).alias("day"), F.bool_or(slot.between(*night)).alias("night")
    )
    return seen.groupBy("period_key").agg(
        F.count_if("day").alias("day_segments"), F.count_if("night").alias("night_segments")
    )


def edge_runs(profile: DataFrame, solid_min: int = SOLID_MIN_SEGMENTS) -> DataFrame:
    """Runs of profile edges of one weight; an edge is solid when both its ends are.

    At most 96 slots per period enter the windows.
    """
    order = Window.partitionBy("period_key").orderBy("timeslot")
    here = F.col("segments") >= solid_min
    edges = (
        profile.withColumn("to_slot", F.lead("timeslot").over(order))
        .withColumn("solid", here & F.lead(here).over(order))
        .filter("to_slot IS NOT NULL")
    )
    changed = F.coalesce(F.lag("solid").over(order) != F.col("solid"), F.lit(False)).cast("int")
    runs = edges.withColumn("_changed", changed).withColumn("run_no", F.sum("_changed").over(order))
    return runs.groupBy("period_key", "run_no").agg(
        F.any_value("solid").alias("solid"),
        F.min("timeslot").alias("from_slot"),
        F.max("to_slot").alias("to_slot"),
        F.count(F.lit(1)).alias("edges"),
    )
