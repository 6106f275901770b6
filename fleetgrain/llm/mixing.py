"""Mix sources to target numbers of words by entropy balancing.

Targets. Sources in code point order, null last, weigh `weights` in turn and
share `percent` of all words by weight; a target stops at `most` times its
source's words and the excess is shared again by weight until none is above.
That is the water level L with target = min(most * words, L * weight).

Rates. Among all document rates whose words meet the targets, entropy balancing
takes those closest to 1 in word-weighted relative entropy. Their dual is
convex: minimise sum(size * exp(x)) - x * target over one x per source, and a
document's rate is exp(x) of its source, an exponential tilt. As a document
counts for one constraint only, the Hessian is diagonal: Newton steps of all
sources run side by side, each on its source's sum of words, without a shuffle.

Copies. Every document is taken floor(rate) times. Which ones are taken once
more is settled per source on a histogram of words by size class and hash bin:
from the class of the longest documents down, whole bins are taken in hash
order as near to the class's goal as they come, and what is left over or
overdrawn is carried to the next smaller class. The histogram of a source has a
bounded number of cells, so no source, however large, meets in one task.

Defined cases: a null text has size 0 and counts for nothing, a text of any
length counts whole; a null doc_id is a document like any other; a null source is
a source of its own; documents of size 0 are taken with the copies of their
source's floor but add no words; repeated rows are documents of their own and
land in the same bin; no documents give no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgrain.session import cut_lineage

WEIGHTS = (3, 1, 2)
PERCENT = 150
MOST = 2
BINS = 1024
NEWTON_STEPS = 60

WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """The rows with the size, size class and hash bin that the mix goes by, in columns named mix_*."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    size_class = F.when(F.col("mix_size") > 0, F.floor(F.log2("mix_size"))).otherwise(-1).cast("int")
    return docs.withColumns({"mix_size": size, "mix_source": F.col("source").cast("string")}).withColumns(
        {"mix_class": size_class, "mix_bin": F.pmod(F.xxhash64("doc_id", "mix_size"), F.lit(BINS)).cast("int")}
    )


def water_level(sources: DataFrame, weights=WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """source, source_size, target; one row per source meets in a window here."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    ring = F.array(*[F.lit(float(w)) for w in weights])
    every = Window.partitionBy()
    cap = F.col("source_size") * most
    ranked = sources.withColumn("nth", F.row_number().over(order)).withColumn(
        "weight", F.element_at(ring, (F.col("nth") - 1) % len(weights) + 1)
    )
    # sources that fill up first come first; those before a source are full when it is looked at
    by_fill = Window.orderBy(cap / F.col("weight"), "nth")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    full_words = F.coalesce(F.sum(cap).over(before), F.lit(0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(every) * percent / 100 - full_words) / open_weight
    seen = ranked.withColumn("level", level).withColumn("place", F.row_number().over(by_fill))
    first_open = F.min(F.when(cap / F.col("weight") >= F.col("level"), F.struct("place", "level"))).over(every)
    return seen.withColumn("first_open", first_open).select(
        "source",
        "source_size",
        F.when(F.col("place") >= F.col("first_open.place"), F.col("first_open.level") * F.col("weight"))
        .otherwise(cap.cast("double"))
        .alias("target"),
    )


def tilt(words: Column, target: Column, steps: int = NEWTON_STEPS) -> Column:
    """The minimiser x of words * exp(x) - x * target, by Newton from 0."""
    share = target / words
    return F.when(
        (words > 0) & (target > 0),
        F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), lambda x, _: x - 1 + share * F.exp(-x)),
    )


EXTRA = "source string, size_class int, last_bin int"


def choose_bins(cells: pd.DataFrame, share: float) -> list[tuple[int, int]]:
    """(size class, last bin taken once more) so that about `share` of the words is taken."""
    chosen, carry = [], 0.0
    for size_class, part in sorted(cells.groupby("size_class"), reverse=True):
        part = part.sort_values("bin")
        sums = np.concatenate([[0], np.cumsum(part["words"].to_numpy())])
        goal = share * sums[-1] + carry
        n = int(np.argmin(np.abs(sums - goal)))
        carry = goal - sums[n]
        if n:
            chosen.append((int(size_class), int(part["bin"].iloc[n - 1])))
    return chosen


def plan(rows: DataFrame, weights=WEIGHTS, percent: int = PERCENT, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """For sized rows: source, source_size, target, rate and floor; and source, size class and last bin taken once more."""
    sources = rows.groupBy(F.col("mix_source").alias("source")).agg(F.sum("mix_size").alias("source_size"))
    rated = cut_lineage(
        water_level(sources, weights, percent, most)
        .withColumn("rate", F.coalesce(F.exp(tilt(F.col("source_size"), F.col("target"))), F.lit(0.0)))
        .withColumn("rate", F.least("rate", F.lit(float(most))))
        .withColumn("floor", F.floor(F.col("rate") + 1e-9).cast("long"))
    )
    cells = (
        rows.where("mix_size > 0")
        .groupBy(F.col("mix_source").alias("source"), F.col("mix_class").alias("size_class"), F.col("mix_bin").alias("bin"))
        .agg(F.sum("mix_size").alias("words"))
    )
    shares = rated.select(F.col("source").alias("of"), (F.col("rate") - F.col("floor")).alias("share"))

    def of_source(frame: pd.DataFrame) -> pd.DataFrame:
        found = choose_bins(frame, max(0.0, float(frame["share"].iloc[0])))
        source = frame["source"].iloc[0]
        return pd.DataFrame([(source, *x) for x in found], columns=["source", "size_class", "last_bin"])

    extra = cells.join(shares, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    return rated, cut_lineage(extra.groupBy("source").applyInPandas(of_source, EXTRA))


def with_copies(rows: DataFrame, rated: DataFrame, extra: DataFrame, most: int = MOST) -> DataFrame:
    """The sized rows with mix_source_size, mix_target, mix_rate and mix_copies. The joined tables hold a few rows per source."""
    by_source = rated.select(
        F.col("source").alias("mix_of"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        F.col("rate").alias("mix_rate"),
        F.col("floor").alias("mix_floor"),
    )
    by_class = extra.select(
        F.col("source").alias("mix_extra"), F.col("size_class").alias("mix_extra_class"), F.col("last_bin").alias("mix_last_bin")
    )
    once_more = F.coalesce((F.col("mix_bin") <= F.col("mix_last_bin")).cast("long"), F.lit(0))
    same_class = F.col("mix_source").eqNullSafe(F.col("mix_extra")) & (F.col("mix_class") == F.col("mix_extra_class"))
    return (
        rows.join(by_source, F.col("mix_source").eqNullSafe(F.col("mix_of")))
        .join(by_class, same_class, "left")
        .withColumn("mix_copies", F.least(F.col("mix_floor") + once_more, F.lit(most).cast("long")))
    )


def mix(docs: DataFrame, weights=WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, rate, copies and taken for every document."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    rows = cut_lineage(sized(chosen).drop("text", "source"))
    return with_copies(rows, *plan(rows, weights, percent, most), most).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.col("mix_rate").alias("rate"),
        F.col("mix_copies").alias("copies"),
        (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


def mixed(docs: DataFrame, weights=WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """The documents, with all their columns, each as often as the mix takes it."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row")
    rows = sized(docs.select(whole, "doc_id", "text", "source")).drop("doc_id", "text", "source")
    narrow = cut_lineage(rows.drop("mix_row"))
    copies = with_copies(rows, *plan(narrow, weights, percent, most), most)
    times = F.expr("if(mix_copies > 0, sequence(1, mix_copies), array())")
    return copies.withColumn("mix_copy", F.explode(times)).select("mix_row.*")
