"""Left join of rows to a table with one row per key, whatever share of the rows a key holds.

A shuffled join sends all rows of a key to one task. The adaptive skew join does
not help here: it splits a partition only when both sides come straight from a
shuffle, and a table of groups comes from an aggregation. The table knows how many
rows each key has, so the split is made from the data: the keys with more than
1/``hot_keys`` of the counted rows are broadcast (fewer than ``hot_keys`` such keys
can exist), and the rows of all other keys, none of them popular, are joined as the
adaptive planner decides from measured sizes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class LookupLimits:
    hot_keys: int = 10_000


def lookup(
    rows: DataFrame, table: DataFrame, on: list[str], weight: str, limits: LookupLimits = LookupLimits()
) -> DataFrame:
    """``rows`` with the columns of ``table``, ``weight`` (rows per key) left out.

    Both sides are read more than once: pass stored frames. Keys must not be NULL.
    """
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("total")).head().total
    popular = F.col(weight) * limits.hot_keys > total
    hot = F.broadcast(table.filter(popular).drop(weight).withColumn("_popular", F.lit(True)))
    cold = table.filter(~popular).drop(weight)
    # One pass tells the rows of popular keys from the others.
    marked = rows.join(hot, on, "left")
    filled = [c for c in table.columns if c not in (*on, weight)]
    others = marked.filter(F.col("_popular").isNull()).drop(*filled).join(cold, on, "left")
    return marked.filter("_popular").drop("_popular").unionByName(others.drop("_popular"))
