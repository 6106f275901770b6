"""Files, manifests and digests held against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgrain.functions.clock import date_in
from fleetgrain.params import MANIFEST_SCHEMA_VERSION


def pending(manifests: DataFrame) -> DataFrame:
    """Closed days nobody has verified against the origin yet."""
    closed = ~F.coalesce("day_in_progress", F.lit(True))
    return manifests.filter(closed & F.col("remote_verified").isNull())


def verify(manifests: DataFrame, observed: DataFrame) -> DataFrame:
    """Verdict per pending day: match, mismatch, or not_found which stays pending."""
    data = observed.select(F.col("file").alias("data_file"), F.col("sha256").alias("data_seen"))
    polls = observed.select(F.col("file").alias("polls_file"), F.col("sha256").alias("polls_seen"))
    joined = pending(manifests).join(data, "data_file", "left").join(polls, "polls_file", "left")
    needs_polls = F.col("polls_file").isNotNull()
    absent = F.col("data_seen").isNull() | (needs_polls & F.col("polls_seen").isNull())
    data_off = F.col("data_seen") != F.col("data_sha256")
    polls_off = needs_polls & ~F.col("polls_seen").eqNullSafe(F.col("polls_sha256"))
    wrong = F.concat_ws(
        ",", F.when(data_off, F.lit("data_sha256")), F.when(polls_off, F.lit("polls_sha256"))
    )
    verdict = F.when(absent, "not_found").when(data_off | polls_off, "mismatch").otherwise("match")
    return joined.select(
        "service_date",
        verdict.alias("verdict"),
        F.when(~absent, ~(data_off | polls_off)).alias("remote_verified"),
        F.when(verdict == "mismatch", wrong).alias("note"),
    )


def carry_verification(rebuilt: DataFrame, previous: DataFrame) -> DataFrame:
    """A passed check survives a rebuild only while both hashes stand."""
    old = previous.select(
        "service_date",
        F.col("remote_verified").alias("_ok"),
        F.col("remote_verified_at").alias("_at"),
        F.col("data_sha256").alias("_data"),
        F.col("polls_sha256").alias("_polls"),
    )
    stands = (
        F.col("_ok").eqNullSafe(True)
        & F.col("data_sha256").eqNullSafe(F.col("_data"))
        & F.col("polls_sha256").eqNullSafe(F.col("_polls"))
    )
    return (
        rebuilt.join(old, "service_date", "left")
        .withColumn("remote_verified", F.when(stands, F.lit(True)))
        .withColumn("remote_verified_at", F.when(stands, F.col("_at")))
        .drop("_ok", "_at", "_data", "_polls")
    )


def stale(manifests: DataFrame, inputs: DataFrame, schema_version: int = MANIFEST_SCHEMA_VERSION) -> DataFrame:
    """Days whose manifest must be rebuilt, with the reason that comes first.

    `inputs` has (service_date, data_mtime, polls_mtime); polls may be null.
    """
    facts = manifests.select(
        "service_date", "schema_version", "remote_verified", "manifest_mtime", F.lit(True).alias("_known")
    )
    reason = (
        F.when(F.col("_known").isNull(), "missing")
        .when(~F.col("schema_version").eqNullSafe(F.lit(schema_version)), "schema")
        .when(F.col("remote_verified").eqNullSafe(F.lit(False)), "failed_check")
        .when(F.col("data_mtime") > F.col("manifest_mtime"), "data_newer")
        .when(F.col("polls_mtime") > F.col("manifest_mtime"), "polls_newer")
    )
    return (
        inputs.join(facts, "service_date", "left")
        .select("service_date", reason.alias("reason"))
        .filter("reason IS NOT NULL")
    )


def gate_violations(manifests: DataFrame, schema_version: int = MANIFEST_SCHEMA_VERSION) -> DataFrame:
    """Days that may not be packaged: other schema, or still running."""
    reason = F.when(~F.col("schema_version").eqNullSafe(F.lit(schema_version)), "schema").when(
        F.coalesce("day_in_progress", F.lit(False)), "in_progress"
    )
    return manifests.select("service_date", reason.alias("reason")).filter("reason IS NOT NULL")


def require_empty(violations: DataFrame, what: str) -> None:
    """Raise with one example when a violations table has rows."""
    found = violations.take(1)
    if found:
        raise ValueError(f"{what}: {found[0].asDict()}")


def hash_violations(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Declared (file, sha256) that are missing or carry other bytes."""
    seen = observed.select("file", F.col("sha256").alias("computed"))
    reason = F.when(F.col("computed").isNull(), "missing").when(
        ~F.col("sha256").eqNullSafe(F.col("computed")), "hash_mismatch"
    )
    return (
        declared.join(seen, "file", "left")
        .select("file", reason.alias("reason"))
        .filter("reason IS NOT NULL")
    )


def missing_days(ranges: DataFrame, manifests: DataFrame) -> DataFrame:
    """Dates of each inclusive (start_date, end_date) range without a manifest."""
    wanted = ranges.select(F.explode(F.sequence("start_date", "end_date")).alias("service_date")).distinct()
    return wanted.join(manifests.select("service_date"), "service_date", "left_anti")


def check_range(start: str, end: str) -> None:
    if end < start:
        raise ValueError(f"nothing to package: the range {start} to {end} runs backwards")


def unconsumed(files: DataFrame, consumed: DataFrame, start: Column, end: Column) -> DataFrame:
    """Files a packaging run leaves behind, with the reason."""
    date = date_in(F.col("name"), r"^(\d{4}-\d{2}-\d{2})\.")
    outside = ~date.between(start, end)
    reason = F.when(F.coalesce(outside, F.lit(False)), "out_of_range").otherwise("unrecognised")
    return files.join(consumed.select("name"), "name", "left_anti").select("name", reason.alias("reason"))


def unprocessed_days(manifests: DataFrame, processed: DataFrame) -> DataFrame:
    """Closed days without processed output."""
    closed = manifests.filter(~F.coalesce("day_in_progress", F.lit(True)))
    return closed.select("service_date").join(processed.select("service_date"), "service_date", "left_anti")


def newest_bundles(bundles: DataFrame, keep: int, keys: list[str]) -> DataFrame:
    """Day bundles with a manifest, those of the newest `keep` days marked published, the rest skipped.

    Only the newest days of each network are ranked, which tasks cut before
    they are shuffled; the oldest of them is the limit for all bundles.
    """
    if keep <= 0:
        raise ValueError(f"the number of days must be positive, got {keep}")
    ready = bundles.filter("has_manifest").select(*keys, "service_date")
    order = Window.partitionBy(*keys).orderBy(F.col("service_date").desc())
    newest = ready.distinct().withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= keep)
    limits = newest.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("service_date").alias("_limit"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return ready.join(limits, same).select(*keys, "service_date", (F.col("service_date") >= F.col("_limit")).alias("published"))


def attribution_conflicts(bundles: DataFrame, keys: list[str]) -> DataFrame:
    """Publications whose bundles name no source or disagree about it."""
    said = F.col("attribution")
    per = bundles.groupBy(*keys).agg(
        F.count_if(F.coalesce(said, F.lit("")) == "").alias("unattributed"),
        F.count_distinct(F.nullif(said, F.lit(""))).alias("attributions"),
    )
    return per.filter((F.col("unattributed") > 0) | (F.col("attributions") != 1))


def period_index(bundles: DataFrame, current: DataFrame) -> DataFrame:
    """Bundles that exist, each marked when it is the current period."""
    marked = current.select(F.col("current_period").alias("bundle"), F.lit(True).alias("is_current"))
    return bundles.join(marked, "bundle", "left").withColumn(
        "is_current", F.coalesce("is_current", F.lit(False))
    )


def index_document(index: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """One row per network: its period bundles, the current one, and the days no median holds, each with its reason.

    `index` is `period_index` with the keys, bundle, first_date and last_date; `excluded` has the keys,
    service_date and excluded_from_median. A network without bundles has its excluded days all the same.
    """
    entry = F.struct("first_date", "bundle", "last_date", "days_in_median")
    listed = index.groupBy(*keys).agg(
        F.max(F.when(F.col("is_current"), F.col("bundle"))).alias("current_period"),
        F.sort_array(F.collect_list(entry)).alias("periods"),
    )
    left_out = (
        excluded.filter("excluded_from_median IS NOT NULL")
        .groupBy(*keys)
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.col("service_date").alias("date"), F.col("excluded_from_median").alias("reason")))
            ).alias("days_excluded_from_median")
        )
    )
    out = listed.join(left_out, keys, "full")
    nothing = {name: F.array().cast(out.schema[name].dataType) for name in ("periods", "days_excluded_from_median")}
    out = out.withColumns({name: F.coalesce(name, none) for name, none in nothing.items()})
    return out.withColumn("period_count", F.size("periods"))


def choose_day_files(files: DataFrame, suffix: str = ".jsonl") -> DataFrame:
    """One file per date out of plain and gzip twins, the plain one first."""
    pattern = r"^(\d{4}-\d{2}-\d{2})" + suffix.replace(".", r"\.") + r"(\.gz)?$"
    zipped = F.col("name").endswith(".gz")
    return (
        files.filter(F.col("name").rlike(pattern))
        .select(date_in(F.col("name"), r"^(.{10})").alias("service_date"), "name", zipped.alias("gz"))
        .filter("service_date IS NOT NULL")
        .groupBy("service_date")
        .agg(F.min_by("name", "gz").alias("name"))
    )


def selected_days(days: DataFrame, today: Column, requested: list[str] | None = None) -> DataFrame:
    """Closed days, or exactly the requested ones."""
    if requested:
        return days.filter(F.col("service_date").isin(*[F.lit(d).cast("date") for d in requested]))
    return days.filter(F.col("service_date") < today)


def planning_days(days: DataFrame, today: Column, requested: DataFrame) -> DataFrame:
    """Every closed day and every requested one, the requested marked processed."""
    asked = requested.select("service_date").distinct().withColumn("_asked", F.lit(True))
    both = days.select("service_date").distinct().join(asked, "service_date", "full_outer")
    processed = F.coalesce("_asked", F.lit(False))
    return both.select("service_date", processed.alias("processed")).filter(
        (F.col("service_date") < today) | F.col("processed")
    )


def copy_verdicts(pairs: DataFrame) -> DataFrame:
    """Plain file against its gzip twin; `whole` and `prefix` are digests of the twin.

    `prefix` covers as many bytes as the plain file has.
    """
    verdict = (
        F.when(F.col("plain") == F.col("whole"), "identical")
        .when((F.col("plain_bytes") < F.col("whole_bytes")) & (F.col("plain") == F.col("prefix")), "truncated")
        .otherwise("diverging")
    )
    return pairs.withColumn("verdict", verdict)
