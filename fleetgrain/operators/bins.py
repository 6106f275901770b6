"""Speed samples to bins, counters and the feed-speed validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.operators import ranks
from fleetgrain.operators.walk import ACCEPTED, HEAD, NO_POSITION, PAIR_REJECTS, UNRESOLVED
from fleetgrain.params import KMH_PER_MS, VALIDATION_DIFF_KMH

BIN_KEYS = ["shape_key", "segment_index", "timeslot"]


def _in_periods(samples: DataFrame, day_plan: DataFrame) -> DataFrame:
    """Speeds with their period and bin. Days outside every period carry a null period_key and do not enter."""
    days = day_plan.filter(F.col("period_key").isNotNull()).select("service_date", "period_key")
    return samples.select("service_date", *BIN_KEYS, "speed_raw").join(days, "service_date")


def typical_bins(samples: DataFrame, day_plan: DataFrame) -> DataFrame:
    """Exact median of the unrounded speed and count per period and bin."""
    keyed = _in_periods(samples, day_plan)
    out = ranks.exact_median(keyed, ["period_key", *BIN_KEYS], "speed_raw", "median")
    return out.select(
        "period_key",
        *BIN_KEYS,
        F.bround("median", 3).alias("median_speed_ms"),
        F.col("n").alias("n_samples"),
    )


def typical_keys(samples: DataFrame, day_plan: DataFrame) -> DataFrame:
    """Period and bin of every row of `typical_bins`, for those who count bins and need no median."""
    keyed = _in_periods(samples, day_plan).filter(F.col("speed_raw").isNotNull())
    return keyed.select("period_key", *BIN_KEYS).distinct()


def day_bins(samples: DataFrame) -> DataFrame:
    """One bundle per day of any kind: median of the rounded speeds."""
    out = ranks.exact_median(samples, ["service_date", *BIN_KEYS], "speed_ms", "median")
    return out.select(
        "service_date", *BIN_KEYS, F.col("median").alias("median_speed_ms"), F.col("n").alias("n_samples")
    )


def day_counters(outcomes: DataFrame) -> DataFrame:
    """Per day and in total (null date): records, pairs, samples and each reject.

    `outcomes` is the small (day, verdict) table, so the rollup moves no fixes.
    """

    def total(names) -> F.Column:
        kept = F.when(F.col("verdict").isin(*names), F.col("records"))
        return F.coalesce(F.sum(kept), F.lit(0))

    rejects = (*UNRESOLVED, NO_POSITION, *PAIR_REJECTS)
    return outcomes.rollup("service_date").agg(
        F.sum("records").alias("records"),
        total((HEAD,)).alias("walks"),
        total((ACCEPTED, *PAIR_REJECTS)).alias("pairs"),
        total((ACCEPTED,)).alias("samples"),
        *[total((name,)).alias(name) for name in rejects],
    )


def feed_speed_validation(
    samples: DataFrame, threshold_kmh: float = VALIDATION_DIFF_KMH
) -> DataFrame:
    """Derived against reported speed over all processed days: one row."""
    diff = F.abs(F.col("speed_raw") * KMH_PER_MS - F.col("feed_speed_kmh"))
    diffs = samples.filter(F.col("feed_speed_kmh").isNotNull()).select(
        F.lit("all").alias("scope"), diff.alias("diff")
    )
    over = diffs.groupBy("scope").agg(F.count_if(F.col("diff") > threshold_kmh).alias("over"))
    middle = ranks.exact_median(diffs, ["scope"], "diff", "median", finer=ranks.FINER)
    return middle.join(over, "scope").select(
        F.col("n").alias("n_compared"),
        F.bround("median", 3).alias("median_abs_diff_kmh"),
        F.bround(100 * F.col("over") / F.col("n"), 3).alias("pct_over_threshold"),
    )


def bin_totals(bins: DataFrame) -> DataFrame:
    """Bins per period, and over all periods: total and distinct."""
    per_bin = bins.groupBy(*BIN_KEYS).agg(F.count(F.lit(1)).alias("periods"))
    return per_bin.agg(
        F.coalesce(F.sum("periods"), F.lit(0)).alias("segment_count"),
        F.count(F.lit(1)).alias("distinct_segment_count"),
    )


def bins_per_period(bins: DataFrame) -> DataFrame:
    return bins.groupBy("period_key").agg(F.count(F.lit(1)).alias("bin_count"))
