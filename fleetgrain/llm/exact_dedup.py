"""Exact copies by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

Texts are equal when they are identical after lower-casing A-Z.

A first pass notes each text's length in bytes and a hash of its first `HEAD`
characters. Lengths that occur twice or more go into a bitmap; of those rows
(length, head) pairs that occur twice or more go into another. A second pass
reads whole texts and hashes those only that the second bitmap marks. A bitmap
has a fixed size and never misses a key; what it marks needlessly costs a hash,
not a wrong result. Counts are combined before they are shuffled, no text is
ever shuffled to find copies, and rows without a possible copy are not either.

Groups are of (length, SHA-256). The facts of the few hot groups are broadcast
and the others joined, so a group with a third of all rows is no single task.

Defined cases: a null text counts as empty, and all empty texts are one group;
texts of any length are hashed whole; of equal texts the row with the largest
doc_id stays, a null doc_id being smaller than any, and of rows that share text
and doc_id exactly one stays; an empty table gives no rows. Other columns of
the input are ignored by `judge` and kept as they are by `keep`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrain.llm.bitsets import bitmap, marked
from fleetgrain.llm.hot_keys import join_by_key
from fleetgrain.session import cut_lineage

HEAD = 64
LENGTH_BITS = 1 << 20
HEAD_BITS = 1 << 26

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is; the quick function is right for ASCII texts only."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def possible_copies(docs: DataFrame) -> DataFrame:
    """The rows with `length`, `head` and `possible`: false only for texts that no other row can equal.

    `docs` has a column `text`; its columns stay.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    facts = {"length": F.octet_length(text), "head": F.xxhash64(lowered(F.substring(text, 1, HEAD)))}
    narrow = cut_lineage(docs.select(*[c.alias(name) for name, c in facts.items()]))
    lengths = narrow.groupBy("length").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("length")
    shared = marked(narrow, [F.col("length")], bitmap(lengths, LENGTH_BITS), LENGTH_BITS, "shared").where("shared")
    heads = shared.groupBy("length", "head").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("length", "head")
    keys = [F.col("length"), F.col("head")]
    return marked(docs.withColumns(facts), keys, bitmap(heads, HEAD_BITS), HEAD_BITS, "possible")


def _digest() -> Column:
    return F.unhex(F.sha2(lowered(F.coalesce(F.col("text").cast("string"), F.lit(""))), 256))


def judge(docs: DataFrame, all_digests: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts without a possible copy are hashed only with `all_digests`, else their text_sha256 is null.
    """
    rows = possible_copies(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = cut_lineage(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "length",
            "possible",
            (_digest() if all_digests else F.when(F.col("possible"), _digest())).alias("digest"),
        )
    )
    groups = cut_lineage(
        rows.where("possible")
        .groupBy("length", "digest")
        .agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size"))
    )
    alone = rows.where("not possible").select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    copies = join_by_key(rows.where("possible"), groups, ["length", "digest"], "group_size").select(
        "doc_id", "digest", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept")
    )
    return alone.unionByName(copies).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, but of equal texts only the row with the largest doc_id.

    Rows without a possible copy pass where they are; of the others the row
    that stays is chosen before the shuffle and once more behind it.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = possible_copies(docs.select(whole, F.col("doc_id").cast("long").alias("doc_id"), "text"))
    # equal rows are told apart by nothing, so any of them may stay
    order = F.struct("doc_id", F.xxhash64("whole"))
    chosen = (
        rows.where("possible")
        .select("length", _digest().alias("digest"), "whole", order.alias("order"))
        .groupBy("length", "digest")
        .agg(F.max_by("whole", "order").alias("whole"))
    )
    return rows.where("not possible").select("whole.*").unionByName(chosen.select("whole.*"))
