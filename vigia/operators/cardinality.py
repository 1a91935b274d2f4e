"""Checks on the "one" side of a join.

A repeated key there multiplies the other side without an error. ``repeated_keys``
reports such keys; ``one_per_key`` makes the running job fail on the first of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def repeated_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    return (
        frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("filas"))
        .filter(F.col("filas") > 1)
    )


def key_summary(frame: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """One row for a table: rows, distinct keys, repeated keys and rows with a missing key."""
    per_key = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return per_key.agg(
        F.lit(name).alias("tabla"),
        F.lit(", ".join(keys)).alias("llave"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("filas"),
        F.count(F.lit(1)).alias("llaves"),
        F.count_if(F.col("_n") > 1).alias("llaves_repetidas"),
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("filas_sin_llave"),
    )


def one_per_key(frame: DataFrame, key: str) -> DataFrame:
    """The same rows, failing the job if ``key`` repeats.

    Rows are counted by key with partial aggregation, so a key with many rows, or a
    missing one, gathers nothing.
    """
    others = [c for c in frame.columns if c != key]
    counted = frame.groupBy(key).agg(F.count(F.lit(1)).alias("_veces"), *[F.max(c).alias(c) for c in others])
    message = F.concat(F.lit(f"{key} repetido: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    single = F.when(F.col("_veces") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.filter(single).select(*frame.columns)
