"""Static feed archives: zip members to typed tables keyed by snapshot."""

from __future__ import annotations

import csv
import hashlib
import io
import itertools
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrain.plans.snapshots import SNAPSHOT_PATTERN

# Members a usable feed must have.
REQUIRED_MEMBERS = ["trips.txt", "shapes.txt", "stops.txt", "routes.txt"]

#: Bytes of a member that are columns at once, and rows at once where rows are read one by one.
_BLOCK_BYTES = 1 << 20
_ROWS_PER_BATCH = 20_000


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """binaryFile rows (snapshot, content), one task per archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "gtfs_*.zip").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.filter(name.rlike(SNAPSHOT_PATTERN)).select(name.alias("snapshot"), "content")


def member_table(archives: DataFrame, member: str, columns: list[str]) -> DataFrame:
    """(snapshot, line_no, the named columns as text) of one CSV member of each archive.

    One scan for each member, a task unzips that member only, as a stream of
    column blocks, and Arrow's reader turns the named columns only into values.
    Defined cases: an unreadable archive, a missing or empty member gives no
    rows; a column the header lacks is null; fields a short row lacks are null,
    those beyond the header are ignored; of columns with one name the last
    counts; a byte-order mark is dropped, blank lines are no rows, and bytes
    that are not UTF-8 become U+FFFD. line_no counts the rows from 0.
    """
    schema = pa.schema([("snapshot", pa.string()), ("line_no", pa.int64()), *[(c, pa.string()) for c in columns]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for snapshot, archive in _archives(batches):
            if member not in archive.namelist():
                continue
            done = 0
            for arrays in _member_columns(archive, member, columns):
                size = len(arrays[0])
                names = pa.repeat(pa.scalar(snapshot, pa.string()), size)
                lines = pa.array(np.arange(done, done + size))
                yield pa.RecordBatch.from_arrays([names, lines, *arrays], schema=schema)
                done += size

    return archives.mapInArrow(run, ", ".join(["snapshot string", "line_no bigint", *[f"`{c}` string" for c in columns]]))


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, zipfile.ZipFile]]:
    """Readable archives; a broken one yields nothing and shows up in `usability`."""
    for batch in batches:
        for snapshot, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            try:
                yield snapshot, zipfile.ZipFile(io.BytesIO(content.as_py()))
            except zipfile.BadZipFile:
                continue


def _member_columns(archive: zipfile.ZipFile, member: str, columns: list[str]) -> Iterator[list[pa.Array]]:
    """Blocks of the named columns; from the first row on that Arrow's reader refuses, row by row."""
    done = 0
    try:
        for batch in _column_blocks(archive, member, columns):
            yield batch.columns
            done += batch.num_rows
    except pa.ArrowInvalid:
        yield from _row_blocks(archive, member, columns, done)


def _column_blocks(archive: zipfile.ZipFile, member: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    with archive.open(member) as raw:
        header = next(csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace", newline="")), [])
    if len(set(header)) < len(header):
        raise pa.ArrowInvalid("several columns of one name")
    with archive.open(member) as raw:
        yield from pacsv.open_csv(
            raw,
            read_options=pacsv.ReadOptions(use_threads=False, block_size=_BLOCK_BYTES),
            parse_options=pacsv.ParseOptions(newlines_in_values=True),
            convert_options=pacsv.ConvertOptions(
                include_columns=columns,
                include_missing_columns=True,
                column_types=dict.fromkeys(columns, pa.string()),
                strings_can_be_null=False,
            ),
        )


def _row_blocks(archive: zipfile.ZipFile, member: str, columns: list[str], start: int) -> Iterator[list[pa.Array]]:
    """The rows from `start` on, ragged or longer than a block."""
    csv.field_size_limit(2**31 - 1)
    with archive.open(member) as raw:
        lines = io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace", newline="")
        rows = itertools.islice(csv.DictReader(lines), start, None)
        for block in itertools.batched(rows, _ROWS_PER_BATCH):
            yield [pa.array([row.get(c) for row in block], pa.string()) for c in columns]


def _member(archives: DataFrame, member: str, columns: dict[str, str]) -> DataFrame:
    rows = member_table(archives, member, list(columns))
    return rows.select("snapshot", *[F.col(name).try_cast(kind).alias(name) for name, kind in columns.items()])


def trips(archives: DataFrame) -> DataFrame:
    names = ("trip_id", "route_id", "service_id", "shape_id")
    return _member(archives, "trips.txt", dict.fromkeys(names, "string"))


def shape_points(archives: DataFrame) -> DataFrame:
    columns = {
        "shape_id": "string",
        "shape_pt_sequence": "int",
        "shape_pt_lat": "double",
        "shape_pt_lon": "double",
    }
    return _member(archives, "shapes.txt", columns)


def routes(archives: DataFrame) -> DataFrame:
    columns = {"route_id": "string", "route_short_name": "string", "route_type": "int"}
    return _member(archives, "routes.txt", columns)


def stops(archives: DataFrame) -> DataFrame:
    return _member(archives, "stops.txt", {"stop_id": "string", "stop_lat": "double", "stop_lon": "double"})


def calendar_dates(archives: DataFrame) -> DataFrame:
    names = ("service_id", "date", "exception_type")
    return _member(archives, "calendar_dates.txt", dict.fromkeys(names, "string"))


def feed_info(archives: DataFrame) -> DataFrame:
    """First feed_info row per snapshot, null when the member is absent."""
    names = ["feed_version", "feed_start_date", "feed_end_date"]
    rows = member_table(archives, "feed_info.txt", names)
    first = rows.groupBy("snapshot").agg(F.min_by(F.struct(*names), "line_no").alias("info"))
    return archives.select("snapshot").join(first, "snapshot", "left").select("snapshot", *[f"info.{n}" for n in names])


def member_names(archives: DataFrame) -> DataFrame:
    """(snapshot, name) of the members each readable archive lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for snapshot, archive in _archives(batches):
            names = archive.namelist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([snapshot] * len(names), pa.string()), pa.array(names, pa.string())], names=["snapshot", "name"]
            )

    return archives.mapInArrow(run, "snapshot string, name string")


def member_digests(archives: DataFrame) -> DataFrame:
    """(snapshot, name, sha256) of every member, for content digests and usability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for snapshot, archive in _archives(batches):
            names = [e.filename for e in archive.infolist() if not e.is_dir()]
            digests = [hashlib.sha256(archive.read(n)).hexdigest() for n in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array([snapshot] * len(names), pa.string()), pa.array(names, pa.string()), pa.array(digests, pa.string())],
                names=["snapshot", "name", "sha256"],
            )

    return archives.mapInArrow(run, "snapshot string, name string, sha256 string")


def usability(archives: DataFrame, members: DataFrame) -> DataFrame:
    """(snapshot, missing): required members each archive lacks, all of them when unreadable."""
    have = members.groupBy("snapshot").agg(F.collect_set("name").alias("have"))
    needed = F.array(*[F.lit(m) for m in REQUIRED_MEMBERS])
    none = F.array().cast("array<string>")
    return (
        archives.select("snapshot")
        .join(have, "snapshot", "left")
        .select("snapshot", F.array_except(needed, F.coalesce("have", none)).alias("missing"))
    )
