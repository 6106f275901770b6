"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Both sides are lower-cased over A-Z and cut into words of ASCII letters, digits
and characters beyond ASCII. Every window of `window` consecutive words of an
item, or the whole of a shorter item, is a pattern " w1 w2 ... "; the automaton
of all patterns runs once over a document's words joined by single spaces, and
positions go back to the original text through the order of its words.

The automaton is broadcast, so its size is bounded: the benchmark is cut by item
into parts of about `part_words` words, mostly one, and the documents are
scanned once for each part. One part at a time is collected, broadcast and
scanned, and its hits are written before the next, so neither the driver nor a
worker holds more than one; the hits of a document are then merged.

Defined cases: texts of any length are scanned whole; a null doc_id is returned
as null, its row judged like any other; null or empty texts and items have no words and no hits; an item
with a null id takes part in hits but is not listed; repeated items are listed
once; repeated documents give a row each; an empty
benchmark contaminates nothing. Other columns of the inputs are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.llm.common import column, encoded, filter_rows, kept_by_worker, rows_kernel
from fleetgrain.session import cut_lineage

WINDOW = 10
PART_WORDS = 2_000_000

_KEEP = [chr(b).isalnum() or b > 0x7F for b in range(256)]
_FOLD = bytes((ord(chr(b).lower()) if b < 0x80 else b) if keep else 0x20 for b, keep in enumerate(_KEEP))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def word_text(raw: bytes | None) -> str:
    """The words of a UTF-8 text with one space before, between and after."""
    words = (raw or b"").translate(_FOLD).split(b" ")
    return (b" " + b" ".join(filter(None, words)) + b" ").decode("utf-8")


def patterns(items: Iterable[tuple[object, str | None]], window: int = WINDOW) -> dict[str, set]:
    """Pattern text to the ids of the items that hold it."""
    found: dict[str, set] = {}
    for item_id, text in items:
        words = word_text((text or "").encode()).split(" ")[1:-1]
        words = [w for w in words if w]
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(" " + " ".join(words[i : i + window]) + " ", set()).add(item_id)
    return found


def automaton(of: dict[str, set]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for text, ids in of.items():
        made.add_word(text, (text.count(" ") - 1, ids))
    made.make_automaton()
    return made


def find(text: str, machine: ahocorasick.Automaton) -> tuple[list[tuple[int, int]], set]:
    """Merged word intervals [first, end) inside pattern occurrences, and the items that occur."""
    ends, sizes, items = [], [], set()
    for at, (size, ids) in machine.iter(text):
        ends.append(at)
        sizes.append(size)
        items |= ids
    if not ends:
        return [], items
    spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
    last = np.searchsorted(spaces, ends)
    merged: list[tuple[int, int]] = []
    for first, end in sorted(zip((last - sizes).tolist(), last.tolist(), strict=True)):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((first, end))
    return merged, items


SCANNED = (
    "doc_id long, text_key long, n_words long, first_words array<long>, end_words array<long>, "
    "starts array<long>, ends array<long>, items array<string>"
)


def _machine_of(shared: Broadcast, window: int) -> Callable[[], ahocorasick.Automaton]:
    """The automaton of a part; a worker keeps one, whatever the number of parts."""
    key = uuid.uuid4().hex
    return lambda: kept_by_worker("automaton", key, lambda: automaton(patterns(shared.value, window)))


def _scan_part(docs: DataFrame, shared: Broadcast, window: int) -> DataFrame:
    machine_here = _machine_of(shared, window)
    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("first_words", longs)]
        + [("end_words", longs), ("starts", longs), ("ends", longs), ("items", pa.list_(pa.string()))]
    )

    def batch_columns(batch):
        machine = machine_here()
        made = {f.name: [] for f in schema}
        for raw in encoded(batch, "text"):
            text = word_text(raw)
            hits, ids = find(text, machine) if len(machine) else ([], set())
            spans = [m.span() for m in _WORD.finditer(raw.decode("utf-8"))] if hits else []
            made["n_words"].append(text.count(" ") - 1 if len(text) > 2 else 0)
            made["first_words"].append([a for a, _ in hits])
            made["end_words"].append([b for _, b in hits])
            made["starts"].append([spans[a][0] for a, _ in hits])
            made["ends"].append([spans[b - 1][1] for _, b in hits])
            made["items"].append(sorted(str(i) for i in ids if i is not None))
        return made | {"doc_id": column(batch, "doc_id"), "text_key": column(batch, "text_key")}

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    return chosen.mapInArrow(rows_kernel(batch_columns, schema), SCANNED)


def _merge_parts(every: DataFrame, n_parts: int) -> DataFrame:
    """Hits of all parts of one document together; a row given k times comes back k times."""
    hits = F.flatten(F.collect_list(F.arrays_zip("first_words", "end_words", "starts", "ends")))
    grouped = every.groupBy("doc_id", "text_key", "n_words").agg(
        (F.count(F.lit(1)) / n_parts).cast("int").alias("copies"),
        F.array_sort(F.array_distinct(hits)).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    kind = "array<struct<first_words:bigint,end_words:bigint,starts:bigint,ends:bigint>>"
    # in order of the first word, a hit joins the one before if they touch
    joined = F.aggregate(
        "hits",
        F.array().cast(kind),
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["first_words"] <= F.element_at(done, -1)["end_words"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["first_words"].alias("first_words"),
                        F.greatest(F.element_at(done, -1)["end_words"], x["end_words"]).alias("end_words"),
                        F.element_at(done, -1)["starts"].alias("starts"),
                        F.greatest(F.element_at(done, -1)["ends"], x["ends"]).alias("ends"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    whole = grouped.withColumn("hits", joined).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    names = ["first_words", "end_words", "starts", "ends"]
    return whole.select("doc_id", "text_key", "n_words", *[F.col(f"hits.{n}").alias(n) for n in names], "items")


def _each_part(benchmark: DataFrame, part_words: int, scanned: Callable[[Broadcast, bool], DataFrame]) -> list[DataFrame]:
    """What `scanned` makes of each part of about `part_words` words, told if it is the only one; of several, one is held at a time."""
    spark = benchmark.sparkSession
    sized = benchmark.select("item_id", "text", (F.length(F.coalesce("text", F.lit(""))) / 2 + 1).alias("size"))
    n_parts = max(1, -(-int(sized.agg(F.sum("size")).first()[0] or 0) // part_words))
    part_of = F.pmod(F.xxhash64("text"), F.lit(n_parts))
    made = []
    for k in range(n_parts):
        shared = spark.sparkContext.broadcast([tuple(r) for r in sized.where(part_of == k).select("item_id", "text").collect()])
        if n_parts == 1:
            return [scanned(shared, True)]
        made.append(cut_lineage(scanned(shared, False)))
        shared.destroy()
    return made


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """One row per document with hit word intervals, their spans in the original and the item ids."""
    parts = _each_part(benchmark, part_words, lambda shared, _: _scan_part(docs, shared, window))
    return parts[0] if len(parts) == 1 else _merge_parts(reduce(DataFrame.unionByName, parts), len(parts))


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs, benchmark, window, part_words)
    n_hit = F.aggregate(
        F.arrays_zip("first_words", "end_words"), F.lit(0).cast("long"), lambda n, x: n + x["end_words"] - x["first_words"]
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("first_words") > 0).alias("contaminated"),
        "starts",
        "ends",
    )


def keep(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """The documents, with all their columns, without a word inside a benchmark passage."""

    def clean_of(shared):
        machine_here = _machine_of(shared, window)

        def clean(batch):
            machine = machine_here()
            if not len(machine):
                return [True] * batch.num_rows
            return [next(machine.iter(word_text(raw)), None) is None for raw in encoded(batch, "text")]

        return clean

    # whether a passage occurs depends on the text alone, so of several parts the digests of such texts are written
    digest, name = F.sha2(F.col("text").cast("binary"), 256), f"hit_{uuid.uuid4().hex}"

    def scanned(shared, only):
        clean = clean_of(shared)
        if only:
            return filter_rows(docs, clean)
        texts = docs.select("text").where("text is not null")
        return filter_rows(texts, lambda batch: [not x for x in clean(batch)]).select(digest.alias(name)).distinct()

    parts = _each_part(benchmark, part_words, scanned)
    return parts[0] if len(parts) == 1 else docs.join(reduce(DataFrame.unionByName, parts), digest == F.col(name), "left_anti")
