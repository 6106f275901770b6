"""Connected components of a large graph by star contraction.

Defined cases: links of a node with itself and repeated links count for nothing;
a link with a null end joins nothing; nodes without another are not in the
result; no links give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    hashes = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashes)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): the root is the smallest node it is joined to.

    Each round hangs the larger neighbours of a node, then the smaller ones,
    below its smallest neighbour (large star, small star). Both are joins with a
    minimum that is combined before the shuffle, so a node with very many edges
    is no single group. A round's edges are a table in the shared folder.
    """
    now = cut_lineage(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = _state(now)
    while state[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut_lineage(rest.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
