"""Latest row per key as a partial aggregation: no window, no sort, no task per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest(frame: DataFrame, key: str, order: str, values: dict[str, str]) -> DataFrame:
    """For each ``key``, the ``values`` (output name → column) of the row with the highest ``order``.

    ``order`` must be unique per key, as the monthly billing grain is.
    """
    return frame.groupBy(key).agg(
        *[
            (F.max(order) if column == order else F.max_by(column, order)).alias(name)
            for name, column in values.items()
        ]
    )
