"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from fleetgrain.session import apply_conf

#: Rows of one Arrow batch. Texts are long, so a batch is small; a batch also
#: bounds what a Python worker holds besides one text.
ROWS_PER_BATCH = 1000

#: Bytes of one Arrow batch, as a few rows may hold long texts or large sets.
BYTES_PER_BATCH = 8 << 20

#: Bytes of text that a kernel takes up at once; one text may be longer.
BYTES_AT_ONCE = 4 << 20

#: `bytes.split()` without argument splits on these and nothing else.
WHITE_BYTES = b" \t\n\r\x0b\x0c"


def prepare(spark: SparkSession) -> SparkSession:
    apply_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _worker() -> dict:
    home = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker"))
    return home.__dict__.setdefault("held", {})


def kept_by_worker(kind: str, key: str, build: Callable[[], object]) -> object:
    """What `build` gives, made once in a Python worker and used by its later tasks.

    Kernels travel by value, so their module globals live for one task only. A
    worker keeps one such object, whatever its kind, so those of earlier jobs
    leave its memory.
    """
    held = _worker()
    if held.get(kind, ("",))[0] != key:
        held.clear()
        held[kind] = (key, build())
    return held[kind][1]


def forget_kept() -> None:
    """Give back what earlier jobs left in this worker; for kernels that need much memory themselves."""
    _worker().clear()
    pa.default_memory_pool().release_unused()


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def encoded(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8, without decoding it."""
    values = batch.column(batch.schema.get_field_index(name))
    return values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()).to_pylist()


def whole(texts: pa.Array) -> pa.Array:
    """A text column with 64-bit offsets that begin at 0.

    Arrow lower-cases the cast of a slice by wrong offsets, so the cast is copied.
    """
    return pa.concat_arrays([texts.cast(pa.large_string())])


class WordCodes:
    """The words of a batch of texts, each word as a number into the batch's distinct words.

    Words are runs of anything but ASCII white space; null has none. Splitting
    and numbering run inside Arrow, so Python meets distinct words only.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(whole(texts), "")
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        words = lists.flatten().dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else np.zeros(1, np.int64)
        keep = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0, bool)
        self.codes = codes[keep]
        self.ends = np.concatenate([[0], np.cumsum(keep)])[ends]
        self.distinct: list[str] = words.dictionary.to_pylist()

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.codes[self.ends[i] : self.ends[i + 1]]


def slices(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of a piece hold about BYTES_AT_ONCE bytes."""
    for batch in batches:
        at = batch.schema.get_field_index(name)
        if at < 0 or batch.nbytes <= BYTES_AT_ONCE:
            if batch.num_rows:
                yield batch
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(sizes) // BYTES_AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def rows_kernel(
    one_batch: Callable[[pa.RecordBatch], dict[str, list]], schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A kernel for mapInArrow from a function of one batch that gives columns."""

    def kernel(batches):
        for batch in slices(batches):
            made = one_batch(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[f.name], type=f.type) for f in schema], schema=schema
            )

    return kernel


def filter_rows(docs: DataFrame, mask: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows, with all their columns, for which a function of a batch says so."""

    def kernel(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array(mask(batch), pa.bool_()))

    return docs.mapInArrow(kernel, docs.schema)
