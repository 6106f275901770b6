"""A set of hashes as a bitmap of fixed size: who is surely not in it is told without a shuffle.

Defined cases: a null key is a key like any other; an empty set holds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrain.session import cut_lineage

#: Bits in one row of a bitmap, as Spark's bitmap functions lay them out.
BITS_IN_ROW = 32_768


def bitmap(keys: DataFrame, n_bits: int) -> DataFrame:
    """The bitmap (set_row, set_bits) of a table of keys; `n_bits` / 8 bytes at most, however many keys there are."""
    place = (F.pmod(F.xxhash64(*keys.columns), F.lit(n_bits)) + 1).alias("place")
    return cut_lineage(
        keys.select(place)
        .groupBy(F.bitmap_bucket_number("place").alias("set_row"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("set_bits"))
    )


def marked(rows: DataFrame, keys: list[Column], held: DataFrame, n_bits: int, name: str) -> DataFrame:
    """The rows with a boolean column: false only where the keys are not in the set."""
    at = F.pmod(F.xxhash64(*keys), F.lit(n_bits))
    byte = "cast(conv(hex(substring(set_bits, cast(set_bit div 8 as int) + 1, 1)), 16, 10) as int)"
    return (
        rows.withColumns({"set_of": F.floor(at / BITS_IN_ROW) + 1, "set_bit": at % BITS_IN_ROW})
        .join(F.broadcast(held), F.col("set_of") == F.col("set_row"), "left")
        .withColumn(name, F.expr(f"coalesce(shiftright({byte}, cast(set_bit % 8 as int)) & 1 = 1, false)"))
        .drop("set_of", "set_bit", "set_row", "set_bits")
    )
