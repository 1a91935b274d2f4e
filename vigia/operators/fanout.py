"""How much a join of two facts on a key multiplies the rows of the first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigia.functions.numbers import ratio


def join_fanout(
    fact_a: DataFrame, fact_b: DataFrame, key: str, only: DataFrame | None = None
) -> DataFrame:
    """One row: direct and joined counts of ``fact_a`` under a left join on ``key``.

    Computed from per-key counts, so the multiplied join is never built. ``only``
    restricts the audit to the keys of another table.
    """
    a = fact_a.groupBy(key).agg(F.count(F.lit(1)).alias("_na"))
    if only is not None:
        a = a.join(only, key, "left_semi")
    b = fact_b.groupBy(key).agg(F.count(F.lit(1)).alias("_nb"))
    per_key = a.join(b, key, "left").select(
        "_na", F.coalesce("_nb", F.lit(0)).alias("_nb"))
    return per_key.agg(
        F.coalesce(F.sum("_na"), F.lit(0)).alias("conteo_directo"),
        F.coalesce(F.sum(F.col("_na") * F.greatest("_nb", F.lit(1))), F.lit(0)).alias("conteo_unido"),
        F.count_if(F.col("_nb") > 1).alias("llaves_multiplicadas"),
    ).withColumn("factor", F.round(ratio(F.col("conteo_unido"), F.col("conteo_directo")), 4))
