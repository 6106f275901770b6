"""City profiles: nested JSON files, one per city, and every rule they break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrain.params import City

# What a profile must state.
REQUIRED_KEYS = ("name", "timezone", "poll_interval_sec", "bbox", "feeds", "attribution")
BBOX_EDGES = ("lat_min", "lat_max", "lon_min", "lon_max")
REQUIRED_FEEDS = ("vehicle_positions", "static")
SPEED_FIELD_UNITS = ("kmh", "ms")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """(slug, text) of profile files; the slug is the file's name without its ending."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    files = spark.read.text(path, wholetext=True)
    return files.select(F.regexp_replace(name, r"\.json$", "").alias("slug"), F.col("value").alias("text"))


def _at(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("profile", f"$.{path}", kind)


def _missing(path: str) -> Column:
    """No such value, JSON null, or an empty text."""
    return F.coalesce(_at(path), F.lit("")) == ""


def _absent(path: str) -> Column:
    kind = F.schema_of_variant(_at(path, "variant"))
    return F.coalesce(kind, F.lit("VOID")) == "VOID"


def _object(path: str) -> Column:
    return F.coalesce(F.schema_of_variant(_at(path, "variant")).startswith("OBJECT"), F.lit(False))


def parsed(profiles: DataFrame) -> DataFrame:
    """Add the profile as a variant, null where the text is null or no JSON object."""
    out = profiles.withColumn("profile", F.try_parse_json("text"))
    return out.withColumn("profile", F.when(F.schema_of_variant("profile").startswith("OBJECT"), F.col("profile")))


def profile_violations(profiles: DataFrame) -> DataFrame:
    """(slug, problem) for every rule that a profile breaks; a part that is not there breaks one rule, not its inner ones."""

    def rule(broken: Column, text: str) -> Column:
        return F.when(F.coalesce(broken, F.lit(False)), F.lit(text))

    edges = {edge: _at(f"bbox.{edge}", "double") for edge in BBOX_EDGES}
    rules = [rule(F.coalesce(_at("slug"), F.lit("")) != F.col("slug"), "declares another slug than its file name")]
    rules += [rule(_absent(key), f"missing required key {key}") for key in REQUIRED_KEYS]
    rules += [rule(_object("bbox") & edges[edge].isNull(), f"bbox is missing {edge}") for edge in BBOX_EDGES]
    for axis in ("lat", "lon"):
        rules.append(rule(edges[f"{axis}_min"] >= edges[f"{axis}_max"], f"bbox has {axis}_min at or above {axis}_max"))
    rules += [rule(~_absent("feeds") & _missing(f"feeds.{feed}"), f"no {feed} feed") for feed in REQUIRED_FEEDS]
    unit = F.coalesce(_at("speed_field_unit"), F.lit(""))
    rules.append(rule(~unit.isin(*SPEED_FIELD_UNITS), "unknown speed field unit"))
    stated = ~_absent("attribution")
    rules += [rule(stated & _missing(f"attribution.{key}"), f"attribution is missing {key}") for key in ("source_name", "licence")]
    licences = _object("attribution.feed_licences")
    rules.append(rule(stated & ~licences, "attribution has no feed_licences map"))
    rules += [
        rule(licences & _missing(f"attribution.feed_licences.{feed}"), f"no licence stated for the {feed} feed")
        for feed in REQUIRED_FEEDS
    ]
    rules.append(rule(~_absent("auth") & _missing("auth.key_env"), "auth names no environment variable"))
    broken = F.when(F.col("profile").isNull(), F.array(F.lit("not a JSON object"))).otherwise(F.array(*rules))
    problems = F.filter(broken, lambda p: p.isNotNull())
    return parsed(profiles).select("slug", F.explode(problems).alias("problem"))


def attributions(profiles: DataFrame) -> DataFrame:
    """(slug, attribution): the profile's own block as JSON text, null where it states none."""
    return parsed(profiles).select("slug", F.to_json(_at("attribution", "variant")).alias("attribution"))


def city(profiles: DataFrame, slug: str) -> City:
    """Parameters of one city; a profile that breaks a rule is refused with all of them."""
    mine = profiles.filter(F.col("slug") == slug)
    broken = [r["problem"] for r in profile_violations(mine).collect()]
    if broken:
        raise ValueError(f"profile {slug}: {'; '.join(sorted(broken))}")
    fields = [_at("timezone").alias("timezone"), _at("poll_interval_sec", "int").alias("poll_interval_sec")]
    fields += [_at(f"bbox.{edge}", "double").alias(edge) for edge in BBOX_EDGES]
    row = parsed(mine).select("slug", *fields, _at("speed_field_unit").alias("speed_field_unit")).first()
    if row is None:
        raise ValueError(f"no profile of {slug}")
    return City(**row.asDict())
