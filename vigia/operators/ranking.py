"""PERCENT_RANK and DENSE_RANK over groups of any size.

A rank window sends each of its groups to one task: all rows for a global rank,
a fifth of them for a rank within the risk class. Instead:

1. The rows become a histogram (group, value, rows). Partial aggregation makes
   popular values harmless.
2. The histogram is range-partitioned in rank order and stored, which fixes the
   sampled range bounds whatever happens to an executor.
3. What lies before a value = the totals of the earlier ranges + the smaller
   values of its own range. The totals are one small row per range.
4. Ranks return to the rows by a lookup that takes popular values apart.

Groups and values travel inside structs: a struct is never NULL, so a missing
group or value meets its like in the lookup, and every column keeps its type.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigia.durable import stored
from vigia.operators.lookup import LookupLimits, lookup

_KEYS = ["_grupo", "_valor"]


def _places(keyed: DataFrame, order: Column) -> DataFrame:
    """Per group and value: its rows, the group's rows, and the rows and values before it in ``order``."""
    histogram = keyed.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("_filas"))
    ranged = stored(
        histogram.repartitionByRange(F.col("_grupo"), order).withColumn("_tramo", F.spark_partition_id()),
        "rangos")
    earlier = Window.partitionBy("_grupo").orderBy("_tramo").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("_grupo", "_tramo").agg(
        F.sum("_filas").alias("_f"), F.count(F.lit(1)).alias("_v")
    ).select(
        "_grupo", "_tramo",
        F.coalesce(F.sum("_f").over(earlier), F.lit(0)).alias("_filas_previas"),
        F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_valores_previos"),
        F.sum("_f").over(Window.partitionBy("_grupo")).alias("_total"),
    )
    inside = Window.partitionBy("_grupo", "_tramo").orderBy(order)
    return stored(
        ranged.join(ranges, ["_grupo", "_tramo"]).select(
            *_KEYS, "_filas", "_total",
            (F.col("_filas_previas") + F.sum("_filas").over(inside) - F.col("_filas")).alias("_filas_antes"),
            (F.col("_valores_previos") + F.row_number().over(inside) - 1).alias("_valores_antes"),
        ),
        "lugares")


def percent_ranks(
    frame: DataFrame, columns: Mapping[str, str], limits: LookupLimits = LookupLimits()
) -> DataFrame:
    """Add the global percent rank, ascending, of each input column (input → output name).

    ``(rank - 1) / (rows - 1)``; ties share the lowest rank, a single row ranks 0 and
    NULL is the lowest value. All columns share one histogram and one lookup.
    """
    rows = stored(frame.withColumn("_fila", F.monotonically_increasing_id()), "filas")
    types = {name: rows.schema[name].dataType for name in columns}

    def value(name: str) -> Column:
        """A struct with a field per column, of which only this one's is filled."""
        return F.struct(
            *[(F.col(c) if c == name else F.lit(None).cast(types[c])).alias(c) for c in columns])

    pairs = F.array(*[F.struct(F.struct(F.lit(c).alias("columna")).alias("_grupo"), value(c).alias("_valor"))
                      for c in columns])
    long = rows.select("_fila", F.inline(pairs))
    others = F.nullif(F.col("_total") - 1, F.lit(0)).cast("double")
    ranks = _places(long, F.col("_valor").asc()).select(
        *_KEYS, "_filas", F.coalesce(F.col("_filas_antes") / others, F.lit(0.0)).alias("_pct"))
    found = lookup(long, ranks, _KEYS, "_filas", limits)
    wide = found.groupBy("_fila").agg(
        *[F.max(F.when(F.col("_grupo.columna") == source, F.col("_pct"))).alias(output)
          for source, output in columns.items()])
    return rows.join(wide, "_fila").select(*frame.columns, *columns.values())


def dense_rank_desc(
    frame: DataFrame, group: str, value: str, output: str, limits: LookupLimits = LookupLimits()
) -> DataFrame:
    """Add the dense rank of ``value`` within ``group``, highest first and NULL last."""
    rows = stored(frame, "filas")
    keyed = rows.withColumns(
        {"_grupo": F.struct(F.col(group).alias("grupo")), "_valor": F.struct(F.col(value).alias("valor"))})
    ranks = _places(keyed.select(*_KEYS), F.col("_valor").desc()).select(
        *_KEYS, "_filas", (F.col("_valores_antes") + 1).cast("int").alias(output))
    return lookup(keyed, ranks, _KEYS, "_filas", limits).select(*frame.columns, output)
