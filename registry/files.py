"""Queries over files, manifests, digests and change capture."""

from __future__ import annotations

from pyspark.sql import functions as F

import driver_views as views
from fleetgrain.functions.clock import local_time
from fleetgrain.operators import capture, digests, reconcile
from fleetgrain.sources import gtfs

SOURCE = ["city"]

MANIFESTS = """
m AS (
  SELECT DATE '2020-01-01' + CAST(doc_id AS INTEGER) AS service_date, doc_id, 'd' || doc_id AS data_file,
         sha256(text) AS data_sha256, CASE WHEN doc_id % 3 = 0 THEN 'p' || doc_id END AS polls_file,
         CASE WHEN doc_id % 3 = 0 THEN sha256(source) END AS polls_sha256,
         doc_id % 50 = 49 AS day_in_progress,
         CASE WHEN doc_id % 20 = 7 THEN 1 WHEN doc_id % 20 = 8 THEN NULL ELSE 2 END AS schema_version,
         CASE WHEN toxic = 1 THEN quality = 1 END AS remote_verified,
         'run-' || lang AS remote_verified_at, doc_id * 10 + n_chars % 30 AS manifest_mtime
  FROM documents LEFT JOIN labels USING (doc_id)),
o AS (
  SELECT 'd' || doc_id AS file, sha256(CASE WHEN doc_id % 7 = 1 THEN text || 'x' ELSE text END) AS sha256
  FROM documents WHERE doc_id % 11 <> 2
  UNION ALL
  SELECT 'p' || doc_id, sha256(CASE WHEN doc_id % 5 = 1 THEN 'other' ELSE source END)
  FROM documents WHERE doc_id % 3 = 0 AND doc_id % 13 <> 3)
"""


def pending_manifests(spark, sf_dir):
    return reconcile.pending(views.doc_manifests(spark, sf_dir)).select("service_date")


PENDING_SQL = f"WITH {MANIFESTS} SELECT service_date FROM m WHERE NOT day_in_progress AND remote_verified IS NULL"


def checksum_verdicts(spark, sf_dir):
    return reconcile.verify(views.doc_manifests(spark, sf_dir), views.doc_observed(spark, sf_dir))


VERDICTS_SQL = f"""WITH {MANIFESTS},
j AS (
  SELECT m.*, d.sha256 AS seen, p.sha256 AS polls_seen,
         d.sha256 IS NULL OR (polls_file IS NOT NULL AND p.sha256 IS NULL) AS absent,
         d.sha256 <> data_sha256 AS data_off, polls_file IS NOT NULL AND p.sha256 <> polls_sha256 AS polls_off
  FROM m LEFT JOIN o d ON d.file = data_file LEFT JOIN o p ON p.file = polls_file
  WHERE NOT day_in_progress AND remote_verified IS NULL)
SELECT service_date, CASE WHEN absent THEN 'not_found' WHEN data_off OR polls_off THEN 'mismatch' ELSE 'match' END
         AS verdict,
       CASE WHEN NOT absent THEN NOT (data_off OR polls_off) END AS remote_verified,
       CASE WHEN NOT absent AND (data_off OR polls_off) THEN
         concat_ws(',', CASE WHEN data_off THEN 'data_sha256' END, CASE WHEN polls_off THEN 'polls_sha256' END)
       END AS note
FROM j"""


def carried_verification(spark, sf_dir):
    """Manifests rebuilt from what the origin holds keep a passed check if both hashes stand."""
    old = views.doc_manifests(spark, sf_dir)
    seen = views.doc_observed(spark, sf_dir)
    data = seen.select(F.col("file").alias("data_file"), F.col("sha256").alias("data_sha256"))
    rebuilt = old.select("service_date", "data_file", "polls_sha256").join(data, "data_file")
    return reconcile.carry_verification(rebuilt, old).select(
        "service_date", "data_sha256", "remote_verified", "remote_verified_at"
    )


CARRIED_SQL = f"""WITH {MANIFESTS}
SELECT service_date, o.sha256 AS data_sha256, CASE WHEN remote_verified AND o.sha256 = data_sha256 THEN true END
         AS remote_verified,
       CASE WHEN remote_verified AND o.sha256 = data_sha256 THEN remote_verified_at END AS remote_verified_at
FROM m JOIN o ON o.file = data_file"""


def stale_manifests(spark, sf_dir):
    manifests = views.doc_manifests(spark, sf_dir)
    docs = views.table(spark, sf_dir, "documents")
    key = F.col("doc_id")
    inputs = docs.select(
        views.doc_date().alias("service_date"),
        (key * 10 + 12).alias("data_mtime"),
        F.when(key % 3 == 0, key * 10 + 20).alias("polls_mtime"),
    )
    known = manifests.join(
        docs.filter("lang <> 'fr'").select(views.doc_date().alias("service_date")), "service_date", "left_semi"
    )
    return reconcile.stale(known, inputs)


STALE_SQL = f"""WITH {MANIFESTS},
j AS (SELECT m.*, lang <> 'fr' AS known, doc_id * 10 + 12 AS data_mtime,
             CASE WHEN doc_id % 3 = 0 THEN doc_id * 10 + 20 END AS polls_mtime
      FROM m JOIN documents USING (doc_id)),
r AS (SELECT service_date, CASE WHEN NOT known THEN 'missing'
        WHEN schema_version IS DISTINCT FROM 2 THEN 'schema'
        WHEN remote_verified = false THEN 'failed_check'
        WHEN data_mtime > manifest_mtime THEN 'data_newer'
        WHEN polls_mtime > manifest_mtime THEN 'polls_newer' END AS reason FROM j)
SELECT * FROM r WHERE reason IS NOT NULL"""


def manifest_gate(spark, sf_dir):
    return reconcile.gate_violations(views.doc_manifests(spark, sf_dir))


GATE_SQL = f"""WITH {MANIFESTS}
SELECT service_date, CASE WHEN schema_version IS DISTINCT FROM 2 THEN 'schema' ELSE 'in_progress' END AS reason
FROM m WHERE schema_version IS DISTINCT FROM 2 OR day_in_progress"""


def file_hash_violations(spark, sf_dir):
    declared = views.doc_manifests(spark, sf_dir).select(
        F.col("data_file").alias("file"), F.col("data_sha256").alias("sha256")
    )
    return reconcile.hash_violations(declared, views.doc_observed(spark, sf_dir))


HASHES_SQL = f"""WITH {MANIFESTS}
SELECT data_file AS file, CASE WHEN sha256 IS NULL THEN 'missing' ELSE 'hash_mismatch' END AS reason
FROM m LEFT JOIN o ON o.file = data_file WHERE sha256 IS NULL OR sha256 <> data_sha256"""


def missing_days(spark, sf_dir):
    """Days between a source's first and last labelled document that no label covers."""
    manifests = views.table(spark, sf_dir, "labels").select(views.doc_date().alias("service_date"))
    docs = views.table(spark, sf_dir, "documents").join(
        views.table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi"
    )
    ranges = docs.groupBy("source").agg(
        F.min(views.doc_date()).alias("start_date"), F.max(views.doc_date()).alias("end_date")
    )
    return reconcile.missing_days(ranges, manifests)


MISSING_SQL = """WITH r AS (
  SELECT min(doc_id) AS a, max(doc_id) AS b FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
  GROUP BY source),
d AS (SELECT DISTINCT unnest(range(a, b + 1)) AS doc_id FROM r)
SELECT DATE '2020-01-01' + CAST(doc_id AS INTEGER) AS service_date FROM d
WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""


def _day_file(suffix):
    return F.concat(F.date_format(views.doc_date(), "yyyy-MM-dd"), F.lit(suffix))


def _day_files(spark, sf_dir):
    """Plain and gzip twins, manifests and foreign names, by document language."""
    docs = views.table(spark, sf_dir, "documents")
    names = (
        F.when(F.col("lang") == "en", F.array(_day_file(".jsonl"), _day_file(".jsonl.gz")))
        .when(F.col("lang") == "de", F.array(_day_file(".jsonl.gz")))
        .when(F.col("lang") == "fr", F.array(_day_file(".jsonl"), _day_file(".manifest.json")))
        .otherwise(F.array(F.concat(F.lit("notes-"), F.col("doc_id").cast("string"))))
    )
    return docs.select(F.explode(names).alias("name"))


DAY_FILES = """
file AS (
  SELECT unnest(CASE lang WHEN 'en' THEN [d || '.jsonl', d || '.jsonl.gz'] WHEN 'de' THEN [d || '.jsonl.gz']
                WHEN 'fr' THEN [d || '.jsonl', d || '.manifest.json'] ELSE ['notes-' || doc_id] END) AS name
  FROM (SELECT *, strftime(DATE '2020-01-01' + CAST(doc_id AS INTEGER), '%Y-%m-%d') AS d FROM documents)),
chosen AS (
  SELECT CAST(name[1:10] AS DATE) AS service_date, min(name) AS name FROM file
  WHERE regexp_matches(name, '^[0-9]{4}-[0-9]{2}-[0-9]{2}[.]jsonl([.]gz)?$') GROUP BY ALL)
"""


def day_file_choice(spark, sf_dir):
    return reconcile.choose_day_files(_day_files(spark, sf_dir))


CHOICE_SQL = f"WITH {DAY_FILES} SELECT * FROM chosen"


def closed_days(spark, sf_dir):
    days = reconcile.choose_day_files(_day_files(spark, sf_dir))
    return reconcile.selected_days(days, F.lit("2021-03-01").cast("date"))


CLOSED_SQL = f"WITH {DAY_FILES} SELECT * FROM chosen WHERE service_date < DATE '2021-03-01'"


def planning_days(spark, sf_dir):
    """All closed days and the labelled ones, which are the requested."""
    days = reconcile.choose_day_files(_day_files(spark, sf_dir))
    asked = views.table(spark, sf_dir, "labels").select(views.doc_date().alias("service_date"))
    return reconcile.planning_days(days, F.lit("2020-06-01").cast("date"), asked)


PLANNING_SQL = f"""WITH {DAY_FILES},
asked AS (SELECT DISTINCT DATE '2020-01-01' + CAST(doc_id AS INTEGER) AS service_date FROM labels)
SELECT service_date, service_date IN (SELECT service_date FROM asked) AS processed
FROM (SELECT service_date FROM chosen UNION SELECT service_date FROM asked)
WHERE service_date < DATE '2020-06-01' OR service_date IN (SELECT service_date FROM asked)"""


def unconsumed_files(spark, sf_dir):
    files = _day_files(spark, sf_dir)
    start, end = F.lit("2020-03-01").cast("date"), F.lit("2021-06-30").cast("date")
    consumed = reconcile.choose_day_files(files).filter(F.col("service_date").between(start, end))
    return reconcile.unconsumed(files, consumed, start, end)


UNCONSUMED_SQL = f"""WITH {DAY_FILES}
SELECT name, CASE WHEN regexp_matches(name, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[.]')
                   AND NOT name[1:10] BETWEEN '2020-03-01' AND '2021-06-30'
                  THEN 'out_of_range' ELSE 'unrecognised' END AS reason
FROM file WHERE name NOT IN (
  SELECT name FROM chosen WHERE service_date BETWEEN DATE '2020-03-01' AND DATE '2021-06-30')"""


def unprocessed_days(spark, sf_dir):
    processed = views.table(spark, sf_dir, "labels").select(views.doc_date().alias("service_date"))
    return reconcile.unprocessed_days(views.doc_manifests(spark, sf_dir), processed)


UNPROCESSED_SQL = f"""WITH {MANIFESTS}
SELECT service_date FROM m WHERE NOT day_in_progress AND doc_id NOT IN (SELECT doc_id FROM labels)"""


def newest_bundles(spark, sf_dir):
    bundles = views.table(spark, sf_dir, "documents").select(
        F.col("source").alias("city"),
        views.doc_date().alias("service_date"),
        (F.col("doc_id") % 5 != 0).alias("has_manifest"),
    )
    return reconcile.newest_bundles(bundles, 7, SOURCE)


BUNDLES_SQL = """SELECT source AS city, DATE '2020-01-01' + CAST(doc_id AS INTEGER) AS service_date,
  row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) <= 7 AS published
FROM documents WHERE doc_id % 5 <> 0"""


def attribution_conflicts(spark, sf_dir):
    """Publications per source number; a language other than the first is another licence."""
    said = F.when(F.col("source").rlike("[05]$"), F.lit("one")).otherwise(F.col("lang"))
    bundles = views.table(spark, sf_dir, "documents").select(
        F.col("source").alias("city"), F.when(F.col("doc_id") % 111 != 10, said).alias("attribution")
    )
    return reconcile.attribution_conflicts(bundles, SOURCE)


ATTRIBUTION_SQL = """WITH b AS (
  SELECT source AS city, CASE WHEN doc_id % 111 <> 10 THEN
    CASE WHEN regexp_matches(source, '[05]$') THEN 'one' ELSE lang END END AS attribution FROM documents),
p AS (SELECT city, count(CASE WHEN attribution IS NULL THEN 1 END) AS unattributed, count(DISTINCT attribution) AS attributions
      FROM b GROUP BY city)
SELECT * FROM p WHERE unattributed > 0 OR attributions <> 1"""


def bundle_index(spark, sf_dir):
    """Bundles per priority with the busiest one marked current."""
    orders = views.table(spark, sf_dir, "orders")
    per = orders.groupBy(F.col("o_orderpriority").alias("bundle")).agg(F.count(F.lit(1)).alias("days"))
    current = per.agg(F.max_by("bundle", F.struct("days", "bundle")).alias("current_period"))
    return reconcile.period_index(per, current)


INDEX_SQL = """WITH p AS (SELECT o_orderpriority AS bundle, count(*) AS days FROM orders GROUP BY 1)
SELECT bundle, days, bundle = (SELECT arg_max(bundle, (days, bundle)) FROM p) AS is_current FROM p"""


def text_digests(spark, sf_dir):
    """Documents as files: digest and size of each one's bytes."""
    files = views.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/files/d"), F.col("doc_id").cast("string")).alias("path"),
        F.col("text").cast("binary").alias("content"),
    )
    return digests.file_digests(files)


DIGESTS_SQL = """SELECT 'd' || doc_id AS file, sha256(text) AS sha256, octet_length(encode(text)) AS size_bytes
FROM documents"""


def alert_set_digests(spark, sf_dir):
    """Digest of each conversation's turns as an unordered set."""
    turns = views.table(spark, sf_dir, "conversations").select("conv_id", "text")
    return digests.set_digest(turns, ["conv_id"], "text")


SET_SQL = """SELECT conv_id, sha256(string_agg(sha256(text), chr(10) ORDER BY sha256(text))) AS digest,
  count(*) AS items FROM conversations GROUP BY conv_id"""


def archive_digests(spark, sf_dir):
    return digests.archive_digest(views.doc_members(spark, sf_dir), ["archive"])


ARCHIVE_SQL = """SELECT source AS archive, count(*) AS items,
  sha256(string_agg('m' || doc_id || ':' || sha256(text), chr(10) ORDER BY 'm' || doc_id, sha256(text))) AS digest
FROM documents GROUP BY source"""


def copy_verdicts(spark, sf_dir):
    """Plain copies of documents held against the whole: same, cut short, or different."""
    docs = views.table(spark, sf_dir, "documents")
    key, half = F.col("doc_id"), F.floor(F.length("text") / 2).cast("int")
    plain = (
        F.when(key % 3 == 0, F.col("text"))
        .when(key % 3 == 1, F.substring(F.col("text"), F.lit(1), half))
        .otherwise(F.concat(F.lit("§"), F.col("text")))
    )
    files = docs.select(
        F.concat(F.lit("d"), key.cast("string")).alias("path"),
        F.col("text").cast("binary").alias("content"),
        F.octet_length(plain).cast("bigint").alias("plain_bytes"),
        F.sha2(plain, 256).alias("plain"),
    )
    twins = digests.twin_digests(files)
    pairs = twins.join(files.select("path", "plain", "plain_bytes"), "path")
    return reconcile.copy_verdicts(pairs).select("path", "plain_bytes", "whole_bytes", "verdict")


COPIES_SQL = """WITH p AS (
  SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN left(text, length(text) // 2)
                       ELSE '§' || text END AS plain FROM documents)
SELECT 'd' || doc_id AS path, octet_length(encode(plain)) AS plain_bytes, octet_length(encode(text)) AS whole_bytes,
       CASE WHEN plain = text THEN 'identical' WHEN starts_with(text, plain) THEN 'truncated' ELSE 'diverging' END
         AS verdict
FROM p"""


def alert_capture(spark, sf_dir):
    out = capture.capture_alerts(
        views.runs(spark, sf_dir), views.RUN_KEYS, views.RUN_ORDER, views.run_bucket()
    )
    return out.select("city", "event_id", "items", "accepted", "kept")


# The fold as the rule states it: last kept digest and last run's count are two memories.
CAPTURE_SQL = """WITH RECURSIVE r AS (
  SELECT event_type AS city, event_id, CAST(floor(value) AS BIGINT) % 3 AS items, user_id % 10 <> 0 AS accepted,
         CASE WHEN CAST(floor(value) AS BIGINT) % 3 = 0 THEN 'none'
              ELSE (CAST(floor(value) AS BIGINT) % 3) || '-' || event_id % 2 END AS digest,
         row_number() OVER (PARTITION BY event_type
           ORDER BY CAST(floor(epoch(ts) / 1200) AS BIGINT), event_id) AS rn FROM events),
f AS (
  SELECT city, rn, event_id, items, accepted, accepted AND items > 0 AS kept,
         CASE WHEN accepted AND items > 0 THEN digest END AS last_kept,
         CASE WHEN accepted THEN items END AS last_count
  FROM r WHERE rn = 1
  UNION ALL
  SELECT city, rn, event_id, items, accepted, kept, CASE WHEN kept THEN digest ELSE last_kept END,
         CASE WHEN accepted THEN items END
  FROM (SELECT r.*, f.last_kept,
               r.accepted AND r.digest IS DISTINCT FROM f.last_kept
                 AND (r.items > 0 OR coalesce(f.last_count = 0, false)) AS kept
        FROM f JOIN r ON r.city = f.city AND r.rn = f.rn + 1))
SELECT city, event_id, items, accepted, kept FROM f"""


def static_capture(spark, sf_dir):
    """Kept feeds with their names: plain for a local day's first, with the clock after."""
    runs = views.runs(spark, sf_dir)
    changed = capture.keep_changes(runs, views.RUN_KEYS, views.RUN_ORDER, views.run_bucket())
    local = local_time(F.col("snapshot_ts"), views.TZ)
    named = capture.name_snapshots(changed.filter("kept"), views.RUN_KEYS, views.RUN_ORDER, local)
    return named.select("city", "event_id", "snapshot")


STATIC_SQL = f"""WITH r AS (
  SELECT event_type AS city, event_id, CAST(floor(epoch(ts) / 1200) AS BIGINT) * 300 + 1278000000 AS snapshot_ts,
         CASE WHEN CAST(floor(value) AS BIGINT) % 3 = 0 THEN 'none'
              ELSE (CAST(floor(value) AS BIGINT) % 3) || '-' || event_id % 2 END AS digest FROM events),
k AS (SELECT *, timezone('{views.TZ}', to_timestamp(snapshot_ts)) AS local,
             lag(digest) OVER (PARTITION BY city ORDER BY snapshot_ts, event_id) AS before FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY city, CAST(local AS DATE) ORDER BY snapshot_ts, event_id) AS nth
      FROM k WHERE digest IS DISTINCT FROM before)
SELECT city, event_id, 'gtfs_' || strftime(local, '%Y-%m-%d') ||
       CASE WHEN nth > 1 THEN 'T' || strftime(local, '%H%M') ELSE '' END || '.zip' AS snapshot FROM n"""

HOURS = f"""
file AS (
  SELECT 'tu_' || strftime(ts, '%Y-%m-%dT%H%M%S') || 'Z.pb' AS name, min(event_id) AS event_id,
         arg_min(props, event_id) AS props FROM events GROUP BY 1),
roles AS (SELECT name, sha256(props) AS sha256, event_id % 6 AS role, name[4:16] AS hour FROM file),
archive AS (SELECT hour, name, sha256 FROM roles WHERE role <= 2),
incoming AS (SELECT name, CASE WHEN role = 1 THEN sha256(sha256 || 'x') ELSE sha256 END AS sha256, hour
             FROM roles WHERE role <> 2),
compared AS (
  SELECT i.hour, i.name, i.sha256, CASE WHEN a.sha256 IS NULL THEN 'new' WHEN a.sha256 = i.sha256 THEN 'same'
         ELSE 'conflict' END AS fate
  FROM incoming i LEFT JOIN archive a USING (hour, name)
  WHERE i.hour < strftime(TIMESTAMP '{views.NOW_UTC}', '%Y-%m-%dT%H'))
"""


def _compared(spark, sf_dir):
    now = F.lit(views.NOW_UTC).cast("timestamp")
    closed = capture.closed_incoming(views.hour_incoming(spark, sf_dir), now)
    return capture.compare_incoming(views.hour_archive(spark, sf_dir), closed)


def hour_merge_fates(spark, sf_dir):
    return _compared(spark, sf_dir)


FATES_SQL = f"WITH {HOURS} SELECT hour, name, sha256, fate FROM compared"


def merged_hours(spark, sf_dir):
    return capture.merge_hours(views.hour_archive(spark, sf_dir), _compared(spark, sf_dir))


MERGED_SQL = f"""WITH {HOURS}
SELECT hour, name, sha256 FROM archive WHERE hour IN (SELECT hour FROM compared WHERE fate = 'new')
UNION ALL SELECT hour, name, sha256 FROM compared WHERE fate = 'new'"""


def hour_leftovers(spark, sf_dir):
    return capture.leftovers(views.hour_incoming(spark, sf_dir), _compared(spark, sf_dir))


LEFTOVERS_SQL = f"""WITH {HOURS}
SELECT name, sha256 FROM incoming WHERE name NOT IN (SELECT name FROM compared WHERE fate <> 'conflict')"""


def hour_completeness(spark, sf_dir):
    return capture.hour_completeness(views.hour_archive(spark, sf_dir), 240)


COMPLETE_SQL = f"""WITH {HOURS}
SELECT hour, count(*) AS files, count(*) * 2 >= 15 AS half_full FROM archive GROUP BY hour"""


FEEDS = """
c AS (SELECT c_custkey AS n, c_custkey // 200 AS block, c_nationkey, c_name, c_mktsegment FROM customer),
f AS (SELECT DISTINCT block, 'f' || block AS snapshot, block % 13 <> 5 AS opens FROM c)
"""


def feed_members(spark, sf_dir):
    """Trips and routes out of zipped feeds."""
    archives = views.feed_archives(spark, sf_dir)
    trips = gtfs.trips(archives).select(
        "snapshot", F.lit("trip").alias("kind"), F.col("trip_id").alias("id"), F.col("service_id").alias("label"),
        F.col("shape_id").alias("detail"),
    )
    routes = gtfs.routes(archives).select(
        "snapshot", F.lit("route").alias("kind"), F.col("route_id").alias("id"), F.col("route_short_name").alias("label"),
        F.col("route_type").cast("string").alias("detail"),
    )
    return trips.unionByName(routes)


MEMBERS_SQL = f"""WITH {FEEDS}
SELECT snapshot, 'trip' AS kind, 'T' || n AS id, c_mktsegment AS label,
  CASE WHEN block % 5 <> 3 AND n % 11 <> 0 THEN 'S' || n % 7 END AS detail
FROM c JOIN f USING (block) WHERE opens
UNION ALL
SELECT snapshot, 'route', 'R' || n, CASE WHEN n % 3 = 0 THEN c_name || ', "' || n || '"' || chr(10) ELSE c_name END,
  CASE WHEN n % 17 <> 3 THEN CAST(n % 4 AS VARCHAR) END
FROM c JOIN f USING (block) WHERE opens AND block % 7 <> 2"""


def feed_versions(spark, sf_dir):
    """What the first row of each feed's feed_info says."""
    return gtfs.feed_info(views.feed_archives(spark, sf_dir))


VERSIONS_SQL = f"""WITH {FEEDS}
SELECT snapshot, CASE WHEN opens AND block % 3 = 0 THEN 'v' || min(n) END AS feed_version,
  CAST(NULL AS VARCHAR) AS feed_start_date, CAST(NULL AS VARCHAR) AS feed_end_date
FROM c JOIN f USING (block) GROUP BY snapshot, opens, block"""


def feed_usability(spark, sf_dir):
    """Required members that each feed lacks."""
    archives = views.feed_archives(spark, sf_dir)
    lacking = gtfs.usability(archives, gtfs.member_names(archives))
    return lacking.select("snapshot", F.array_join("missing", ",").alias("missing"), (F.size("missing") == 0).alias("usable"))


USABILITY_SQL = f"""WITH {FEEDS},
m AS (SELECT snapshot, concat_ws(',', CASE WHEN NOT opens THEN 'trips.txt,shapes.txt' END,
  CASE WHEN NOT opens OR block % 4 = 1 THEN 'stops.txt' END,
  CASE WHEN NOT opens OR block % 7 = 2 THEN 'routes.txt' END) AS missing FROM f)
SELECT snapshot, missing, missing = '' AS usable FROM m"""


QUERIES = {
    "pending_manifests": (pending_manifests, PENDING_SQL),
    "checksum_verdicts": (checksum_verdicts, VERDICTS_SQL),
    "carried_verification": (carried_verification, CARRIED_SQL),
    "stale_manifests": (stale_manifests, STALE_SQL),
    "manifest_gate": (manifest_gate, GATE_SQL),
    "file_hash_violations": (file_hash_violations, HASHES_SQL),
    "missing_days": (missing_days, MISSING_SQL),
    "day_file_choice": (day_file_choice, CHOICE_SQL),
    "closed_days": (closed_days, CLOSED_SQL),
    "planning_days": (planning_days, PLANNING_SQL),
    "unconsumed_files": (unconsumed_files, UNCONSUMED_SQL),
    "unprocessed_days": (unprocessed_days, UNPROCESSED_SQL),
    "newest_bundles": (newest_bundles, BUNDLES_SQL),
    "attribution_conflicts": (attribution_conflicts, ATTRIBUTION_SQL),
    "bundle_index": (bundle_index, INDEX_SQL),
    "text_digests": (text_digests, DIGESTS_SQL),
    "alert_set_digests": (alert_set_digests, SET_SQL),
    "archive_digests": (archive_digests, ARCHIVE_SQL),
    "feed_members": (feed_members, MEMBERS_SQL),
    "feed_versions": (feed_versions, VERSIONS_SQL),
    "feed_usability": (feed_usability, USABILITY_SQL),
    "copy_verdicts": (copy_verdicts, COPIES_SQL),
    "alert_capture": (alert_capture, CAPTURE_SQL),
    "static_capture": (static_capture, STATIC_SQL),
    "hour_merge_fates": (hour_merge_fates, FATES_SQL),
    "merged_hours": (merged_hours, MERGED_SQL),
    "hour_leftovers": (hour_leftovers, LEFTOVERS_SQL),
    "hour_completeness": (hour_completeness, COMPLETE_SQL),
}
