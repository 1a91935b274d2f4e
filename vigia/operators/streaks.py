"""Length of the run of equal flags that ends at each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def streaks(
    frame: DataFrame, flag: Column, by: Sequence[str], order: str, length: str, side: str
) -> DataFrame:
    """Adds ``side`` (the flag, unknown counts as false) and ``length``.

    Groups must be short series (the month axis of one entity).
    """
    series = Window.partitionBy(*by).orderBy(order)
    marked = frame.withColumn(side, F.coalesce(flag, F.lit(False)))
    starts = F.coalesce(F.col(side) != F.lag(side).over(series), F.lit(True))
    islands = marked.withColumn("_starts", starts.cast("int")).withColumn(
        "_island", F.sum("_starts").over(series))
    in_island = Window.partitionBy(*by, "_island").orderBy(order)
    return islands.withColumn(length, F.row_number().over(in_island)).drop("_starts", "_island")
