"""Dense month axes, so that a month without data is a row and not a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigia.calendar import MonthWindow
from vigia.functions.dates import months_between


#: Least number of tasks of a spread axis.
AXIS_TASKS = 200


def entity_months(entities: DataFrame, window: MonthWindow, spread: str | None = None) -> DataFrame:
    """Each entity row repeated for every month of the window; a narrow operation.

    A table of entities is small and lies in a few tasks, its months are many. ``spread`` names a column by which
    the entities move to many tasks first, so that none holds the months of a large part of them. The number
    of tasks is given, since the adaptive planner would merge them by the size of what they read.
    """
    if spread is not None:
        spark = entities.sparkSession
        tasks = max(AXIS_TASKS, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        entities = entities.repartition(tasks, spread)
    return entities.withColumn("periodo", F.explode(months_between(window.start, window.month)))
