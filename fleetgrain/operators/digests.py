"""Content digests of files, archives and unordered sets."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHUNK = 1 << 20


def file_digests(files: DataFrame) -> DataFrame:
    """(file, sha256, size_bytes) over uncompressed bytes of binaryFile rows (path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, digests, sizes = [], [], []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                digest, size = hashlib.sha256(), 0
                for chunk in plain_chunks(path, memoryview(content.as_buffer())):
                    digest.update(chunk)
                    size += len(chunk)
                names.append(path.rsplit("/", 1)[-1])
                digests.append(digest.hexdigest())
                sizes.append(size)
            yield pa.RecordBatch.from_pydict(
                {"file": names, "sha256": digests, "size_bytes": pa.array(sizes, pa.int64())}
            )

    return files.select("path", "content").mapInArrow(run, "file string, sha256 string, size_bytes bigint")


def plain_chunks(path: str, content: memoryview) -> Iterator[bytes]:
    """The file's bytes in chunks, gunzipped on the way when it is a .gz."""
    if not path.endswith(".gz"):
        for at in range(0, len(content), _CHUNK):
            yield bytes(content[at : at + _CHUNK])
        return
    inflate = zlib.decompressobj(wbits=31)
    for at in range(0, len(content), _CHUNK):
        data = bytes(content[at : at + _CHUNK])
        while data:
            yield inflate.decompress(data)
            data = inflate.unused_data
            if data:  # another gzip member follows
                inflate = zlib.decompressobj(wbits=31)
    yield inflate.flush()


def ordered_digest(
    rows: DataFrame, keys: list[str], item: str, separator: str, order: list[str] | None = None
) -> DataFrame:
    """(keys, digest, items): sha256 of each group's items, sorted and joined.

    Hashing in sorted order is sequential by definition, so a group ends in one
    task, but as a stream over a sorted partition: the group is never held.
    """
    types = dict(rows.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", digest string, items bigint"
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, *(order or [item]))
    return ordered.select(*keys, item).mapInArrow(_hash_stream(len(keys), separator.encode()), schema)


def _hash_stream(width: int, separator: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, items, schema = None, None, 0, None
        for batch in batches:
            schema = batch.schema
            done = []
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                if row[:width] != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest(), items))
                    key, digest, items = row[:width], hashlib.sha256(), 0
                if items:
                    digest.update(separator)
                digest.update(row[width].encode())
                items += 1
            if done:
                yield _rows(done, schema, width)
        if key is not None:
            yield _rows([(*key, digest.hexdigest(), items)], schema, width)

    return run


def _rows(rows: list[tuple], schema: pa.Schema, width: int) -> pa.RecordBatch:
    fields = [schema.field(i) for i in range(width)]
    fields += [pa.field("digest", pa.string()), pa.field("items", pa.int64())]
    arrays = [pa.array(values, f.type) for values, f in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))


def set_digest(payloads: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """Digest of an unordered multiset of payloads, blind to their order and ids."""
    hashed = payloads.select(*keys, F.sha2(F.col(payload), 256).alias("_item"))
    return ordered_digest(hashed, keys, "_item", "\n")


def archive_digest(members: DataFrame, keys: list[str]) -> DataFrame:
    """Digest of an archive's (name, sha256) members, blind to packing order and dates."""
    named = members.select(*keys, "name", "sha256", F.concat_ws(":", "name", "sha256").alias("_item"))
    return ordered_digest(named, keys, "_item", "\n", order=["name", "sha256"])


def twin_digests(files: DataFrame) -> DataFrame:
    """One row per gzip file and plain byte length: digest of the whole and of that prefix.

    `files` has (path, content, plain_bytes).
    """
    schema = T.StructType().add("path", "string").add("whole", "string")
    schema = schema.add("whole_bytes", "long").add("prefix", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in schema.names}
            paths, contents, lengths = batch.columns
            for path, content, length in zip(paths.to_pylist(), contents, lengths.to_pylist()):
                whole, prefix, size = hashlib.sha256(), hashlib.sha256(), 0
                for chunk in plain_chunks(path, memoryview(content.as_buffer())):
                    whole.update(chunk)
                    prefix.update(chunk[: max(0, length - size)])
                    size += len(chunk)
                for name, value in zip(out, (path, whole.hexdigest(), size, prefix.hexdigest())):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out)

    return files.select("path", "content", "plain_bytes").mapInArrow(run, schema)
