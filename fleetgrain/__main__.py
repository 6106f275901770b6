"""Command line: speeds, export, manifests and profile over an archive folder."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from fleetgrain.functions.clock import date_in
from fleetgrain.operators import profile, quality, reconcile
from fleetgrain.operators.digests import file_digests
from fleetgrain.params import MANIFEST_SCHEMA_VERSION, MIN_SAMPLES, WalkParams
from fleetgrain.plans import export, periods, pipeline, snapshots
from fleetgrain.session import build_session, cut_lineage
from fleetgrain.sinks import replace_tree, write_manifests
from fleetgrain.sources import jsonl, listings, profiles


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fleetgrain", description=__doc__)
    parser.add_argument("--master", help="Spark master; default is the environment's")
    jobs = parser.add_subparsers(dest="job", required=True)
    speeds = jobs.add_parser("speeds", help="samples, bins and the run's record")
    speeds.add_argument("data_dir")
    speeds.add_argument("static_dir")
    speeds.add_argument("--date", action="append", default=[], help="only these days; repeatable")
    export_job = jobs.add_parser("export", help="serving tables of periods and days")
    export_job.add_argument("static_dir")
    export_job.add_argument("--min-samples", type=int, default=MIN_SAMPLES)
    export_job.add_argument("--profile", help="the city's profile file, for its attribution")
    manifests = jobs.add_parser("manifests", help="quality record of every day")
    manifests.add_argument("data_dir")
    verify = jobs.add_parser("verify", help="hold pending records against the origin's checksums")
    verify.add_argument("checksums", help="lines of digest and file name")
    package = jobs.add_parser("package-check", help="whether a range of days may be packaged")
    package.add_argument("data_dir")
    package.add_argument("start")
    package.add_argument("end")
    profiles = jobs.add_parser("profile", help="time-of-day tables of a period")
    profiles.add_argument("--period", help="default: the current one")
    profiles.add_argument("--against", help="an earlier period to compare with")
    for job in (speeds, export_job, manifests, profiles, verify, package):
        job.add_argument("out", help="folder the tables are written to and read from")
    manifests.add_argument("--force", action="store_true", help="redo days whose record is current")
    for job in (speeds, export_job, manifests):
        job.add_argument("--city", default="city")
    for job in (speeds, manifests):
        job.add_argument("--timezone", default="UTC")
        job.add_argument("--interval", type=int, default=45, help="poll interval in seconds")
    speeds.add_argument("--speed-unit", choices=("kmh", "ms"), default="kmh")
    return parser


def run_export(spark, args) -> None:
    static = pipeline.load_static(spark, args.static_dir, f"{args.out}/static", args.city)
    plan = spark.read.parquet(f"{args.out}/day_plan").filter("processed")
    manifests = spark.read.parquet(f"{args.out}/manifests") if _has(spark, f"{args.out}/manifests") else None
    stored = spark.read.parquet(f"{args.out}/bins").withColumn("period_key", F.col("period_key").cast("string"))
    behind = plan.filter("period_key IS NOT NULL").select(F.col("period_key").alias("bundle"), "service_date")
    about = spark.read.parquet(f"{args.out}/periods")
    attribution = None
    if args.profile:
        known = profiles.read_profiles(spark, args.profile)
        reconcile.require_empty(profiles.profile_violations(known), "the profile breaks a rule")
        attribution = profiles.attributions(known).first()["attribution"]
    records = export.export_bundles(
        export.period_bundles(stored), behind, static, manifests, f"{args.out}/typical", args.min_samples,
        about=about, attribution=attribution, source=f"{args.out}/bins",
    )
    index = export.bundle_index(records, about)
    document = reconcile.index_document(
        index.withColumn("city", F.lit(args.city)), plan.withColumn("city", F.lit(args.city)), ["city"]
    )
    replace_tree(document, f"{args.out}/period_index")
    used = plan.select(F.explode(F.array("snapshot", "next_snapshot")).alias("snapshot")).filter("snapshot IS NOT NULL")
    replace_tree(snapshots.unloaded_feeds(used, static.catalogue.select("snapshot")), f"{args.out}/unloaded_feeds")
    samples = spark.read.parquet(f"{args.out}/samples")
    days = plan.select(F.date_format("service_date", "yyyy-MM-dd").alias("bundle"), "service_date")
    by_day = export.export_bundles(
        export.day_bundles(samples), days, static, manifests, f"{args.out}/by_day", args.min_samples,
        mode=export.SINGLE_DAY, attribution=attribution, source=f"{args.out}/samples",
    )
    replace_tree(export.root_index(by_day, index), f"{args.out}/index")
    index.show(truncate=False)


def _has(spark, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def run_manifests(spark, args) -> None:
    """Quality records of the listed days whose record is missing or out of date; a passed check is carried."""
    listed = listings.list_files(spark, args.data_dir, "????-??-??*.jsonl*")
    mtime = listed.select("name", F.unix_timestamp("modified").alias("mtime"))
    data = reconcile.choose_day_files(listed).join(mtime, "name")
    beats = reconcile.choose_day_files(listed, ".polls.jsonl").join(mtime, "name")
    path = f"{args.out}/manifests"
    old = cut_lineage(spark.read.parquet(path)) if _has(spark, path) else None
    days = data.select("service_date", F.col("name").alias("data_name"), F.col("mtime").alias("data_mtime")).join(
        beats.select("service_date", F.col("name").alias("polls_name"), F.col("mtime").alias("polls_mtime")),
        "service_date",
        "left",
    )
    if old is not None and not args.force:
        days = days.join(reconcile.stale(old, days), "service_date", "left_semi")
    days = cut_lineage(days)
    chosen = days.select("data_name", "polls_name").collect()  # one row per calendar day
    if not chosen:
        return
    names = [n for row in chosen for n in row if n]
    positions = jsonl.read_positions(spark, [f"{args.data_dir}/{r['data_name']}" for r in chosen])
    beat_paths = [f"{args.data_dir}/{r['polls_name']}" for r in chosen if r["polls_name"]]
    polls = jsonl.read_polls(spark, beat_paths) if beat_paths else spark.createDataFrame([], jsonl.POLL_ROWS)
    bad_data = jsonl.line_counts(spark, [f"{args.data_dir}/{r['data_name']}" for r in chosen])
    bad_polls = jsonl.line_counts(spark, beat_paths, jsonl.POLL_SCHEMA) if beat_paths else bad_data.limit(0)
    contents = listings.file_contents(spark, [f"{args.data_dir}/{n}" for n in names])
    is_beat = F.col("file").contains(".polls.jsonl")
    digests = (
        file_digests(contents)
        .withColumn("service_date", date_in(F.col("file"), r"^(.{10})"))
        .groupBy("service_date")
        .agg(
            F.max(F.when(~is_beat, F.col("sha256"))).alias("data_sha256"),
            F.max(F.when(~is_beat, F.col("size_bytes"))).alias("data_size_bytes"),
            F.max(F.when(is_beat, F.col("sha256"))).alias("polls_sha256"),
        )
    )
    date = F.date_format("service_date", "yyyy-MM-dd")
    # files are named as they are uncompressed, as the digests are
    files = (
        days.join(digests, "service_date", "left")
        .join(bad_data.select(F.col("file").alias("data_name"), F.col("malformed").alias("data_malformed_lines")), "data_name", "left")
        .join(bad_polls.select(F.col("file").alias("polls_name"), F.col("malformed").alias("polls_malformed_lines")), "polls_name", "left")
        .withColumns(
            {
                "data_file": F.concat(date, F.lit(".jsonl")),
                "polls_file": F.when(F.col("polls_name").isNotNull(), F.concat(date, F.lit(".polls.jsonl"))),
                "compressed": F.col("data_name").endswith(".gz"),
                "heartbeat_available": F.col("polls_name").isNotNull(),
            }
        )
        .fillna(0, ["data_malformed_lines", "polls_malformed_lines", "data_size_bytes"])
        .fillna(listings.EMPTY_SHA256, ["data_sha256"])
        .withColumn(
            "polls_sha256", F.when(F.col("polls_name").isNotNull(), F.coalesce("polls_sha256", F.lit(listings.EMPTY_SHA256)))
        )
        .drop("data_name", "polls_name", "data_mtime", "polls_mtime")
    )
    now = F.unix_timestamp(F.current_timestamp())
    made = quality.day_manifests(positions, polls, files, args.timezone, now, args.interval)
    made = made.withColumns(
        {
            "schema_version": F.lit(MANIFEST_SCHEMA_VERSION),
            "manifest_mtime": now,
            "nominal_interval_sec": F.lit(args.interval),
            "generated_at": _iso_now(),
        }
    )
    none = spark.createDataFrame(
        [],
        "service_date date, remote_verified boolean, remote_verified_at string, data_sha256 string, polls_sha256 string",
    )
    carried = reconcile.carry_verification(made, none if old is None else old)
    write_manifests(carried.withColumn("remote_verify_note", F.lit(None).cast("string")), path)


def _iso_now():
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_verify(spark, args) -> None:
    """Hold pending records against the origin's checksums and keep each verdict in the record."""
    path = f"{args.out}/manifests"
    records = cut_lineage(spark.read.parquet(path))
    parts = F.split(F.trim("value"), r"\s+\*?", 2)
    lines = spark.read.text(args.checksums).filter(F.trim("value") != "")
    observed = lines.select(F.element_at(parts, 2).alias("file"), F.lower(F.element_at(parts, 1)).alias("sha256"))
    verdicts = cut_lineage(reconcile.verify(records, observed))
    found = verdicts.filter("remote_verified IS NOT NULL").select(
        "service_date", F.col("remote_verified").alias("_ok"), F.col("note").alias("_note")
    )
    checked = records.join(found, "service_date").withColumns(
        {"remote_verified": F.col("_ok"), "remote_verified_at": _iso_now(), "remote_verify_note": F.col("_note")}
    )
    write_manifests(checked.drop("_ok", "_note"), path)
    replace_tree(verdicts.orderBy("service_date"), f"{args.out}/verify")


def run_package_check(spark, args) -> None:
    """Everything that forbids packaging a range of days, in one table; the job fails while it has rows.

    Files that the range leaves behind are listed too, and forbid nothing.
    """
    reconcile.check_range(args.start, args.end)
    start, end = (F.lit(d).cast("date") for d in (args.start, args.end))
    records = spark.read.parquet(f"{args.out}/manifests")
    inside = records.filter(F.col("service_date").between(start, end))
    span = spark.range(1).select(start.alias("start_date"), end.alias("end_date"))
    listed = listings.list_files(spark, args.data_dir, "*.jsonl*").select("name", "bytes")
    plain = F.regexp_replace("name", r"\.gz$", "")
    declared = inside.select("data_file", "data_sha256", "polls_file", "polls_sha256")
    declared = declared.select(F.col("data_file").alias("file"), F.col("data_sha256").alias("sha256")).unionByName(
        declared.filter("polls_file IS NOT NULL").select(
            F.col("polls_file").alias("file"), F.col("polls_sha256").alias("sha256")
        )
    )
    contents = listings.file_contents(spark, args.data_dir, "*.jsonl*")
    observed = file_digests(contents).select(F.regexp_replace("file", r"\.gz$", "").alias("file"), "sha256")
    empty = listed.filter("bytes = 0").select(F.col("name").alias("file"), F.lit(listings.EMPTY_SHA256).alias("sha256"))
    observed = observed.unionByName(empty)
    consumed = listed.join(declared.select(F.col("file").alias("_file")), plain == F.col("_file"), "left_semi")
    day = F.col("service_date").cast("string")
    blocking = (
        reconcile.gate_violations(inside).select(F.lit("manifest").alias("what"), day.alias("item"), "reason")
        .unionByName(
            reconcile.missing_days(span, records).select(
                F.lit("manifest").alias("what"), day.alias("item"), F.lit("missing").alias("reason")
            )
        )
        .unionByName(
            reconcile.hash_violations(declared, observed).select(F.lit("file").alias("what"), F.col("file").alias("item"), "reason")
        )
    )
    replace_tree(blocking.orderBy("what", "item"), f"{args.out}/package_check")
    replace_tree(reconcile.unconsumed(listed, consumed, start, end).orderBy("name"), f"{args.out}/left_behind")
    reconcile.require_empty(spark.read.parquet(f"{args.out}/package_check"), "the range can't be packaged")


def run_profile(spark, args) -> None:
    stored = spark.read.parquet(f"{args.out}/bins").withColumn("period_key", F.col("period_key").cast("string"))
    current = periods.current_period(spark.read.parquet(f"{args.out}/periods"), []).first()
    key = args.period or (current and current["current_period"])
    if key is None:
        raise SystemExit("no schedule period holds a weekday median")
    table = profile.segment_table(stored)
    mine = table.filter(F.col("period_key") == key)
    found = profile.network_profile(mine)
    tables = {
        "slots": found.orderBy("timeslot"),
        "extremes": profile.core_extremes(found),
        "paired": profile.paired(mine),
        "persistence": profile.persistence(mine).orderBy("cut_kmh"),
        "populations": profile.populations(mine),
    }
    if args.against:
        tables["common"] = profile.common_segments(table, key, args.against)
        tables["against"] = profile.against(table, key, args.against).orderBy("label")
    for name, df in tables.items():
        replace_tree(df, f"{args.out}/profile/{name}")
        print(f"{args.out}/profile/{name}")
        spark.read.parquet(f"{args.out}/profile/{name}").show(20, truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(args.master)
    if args.job == "speeds":
        params = WalkParams(
            poll_interval_sec=args.interval, timezone=args.timezone, speed_field_unit=args.speed_unit
        )
        run = pipeline.run_speeds(
            spark, args.data_dir, args.static_dir, args.out, args.city, params, dates=args.date
        )
        run.unusable.show(truncate=False)
        run.days.orderBy(F.desc_nulls_first("service_date")).show(truncate=False)
        run.summary.show(truncate=False)
    elif args.job == "export":
        run_export(spark, args)
    elif args.job == "manifests":
        run_manifests(spark, args)
    elif args.job == "verify":
        run_verify(spark, args)
    elif args.job == "package-check":
        run_package_check(spark, args)
    else:
        run_profile(spark, args)


if __name__ == "__main__":
    main()
