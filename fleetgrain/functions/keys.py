"""Content keys, composite keys and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_HEX_CHARS = 16

# Public transport route type codes and their labels.
ROUTE_TYPE_LABELS = {
    0: "Tram",
    1: "Metro",
    2: "Rail",
    3: "Bus",
    4: "Ferry",
    5: "Cable tram",
    6: "Aerial lift",
    7: "Funicular",
    11: "Trolleybus",
    12: "Monorail",
}
UNKNOWN_ROUTE_TYPE = -1
UNKNOWN_LABEL, UNLISTED_LABEL = "Unknown type", "Type "


def short_digest(text: Column) -> Column:
    return F.left(F.sha2(text, 256), F.lit(KEY_HEX_CHARS))


def geometry_key(points: Column) -> Column:
    """Key of an ordered array of struct(lat, lon): the geometry and nothing else."""
    texts = F.transform(points, lambda p: F.format_string("%.6f,%.6f", p["lat"], p["lon"]))
    return short_digest(F.array_join(texts, ";"))


def counts_key(pairs: Column) -> Column:
    """Key of an unordered array of struct(route_id, trips)."""
    texts = F.transform(
        F.sort_array(pairs),
        lambda p: F.concat(p["route_id"], F.lit(","), p["trips"].cast("string")),
    )
    return short_digest(F.array_join(texts, ";"))


def bin_key(shape_key: Column, segment_index: Column, timeslot: Column) -> Column:
    return F.concat_ws("|", shape_key, segment_index.cast("string"), timeslot)


def split_bin_key(key: Column) -> list[Column]:
    parts = F.split(key, r"\|")
    return [
        parts[0].alias("shape_key"),
        parts[1].cast("int").alias("segment_index"),
        parts[2].alias("timeslot"),
    ]


def route_type_label(code: Column) -> Column:
    known = F.create_map(*[F.lit(v) for kv in ROUTE_TYPE_LABELS.items() for v in kv])
    return (
        F.when(code == UNKNOWN_ROUTE_TYPE, F.lit(UNKNOWN_LABEL))
        .otherwise(F.coalesce(F.try_element_at(known, code), F.concat(F.lit(UNLISTED_LABEL), code.cast("string"))))
    )


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
