"""Joins of rows with one fact per key where one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of all rows is hot, so there are fewer hot keys than this.
HOT_SHARE = 256


def join_by_key(rows: DataFrame, facts: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Rows joined with the fact of their key, no key more than a `HOT_SHARE`th of all rows in one task.

    `facts` has one row per key and in `size` the number of its rows. Facts of hot
    keys, fewer than `HOT_SHARE`, are broadcast; the rest meet in a shuffle. Both
    inputs are read twice, so they should be stored tables. Defined cases: rows
    whose key is null or has no fact are left out; no facts, no rows.
    """
    total = facts.agg(F.sum(size)).first()[0] or 0
    hot = facts.where(F.col(size) * HOT_SHARE > total)
    cold = facts.where(F.col(size) * HOT_SHARE <= total)
    of_hot = rows.join(F.broadcast(hot), keys)
    of_cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return of_hot.unionByName(of_cold)
