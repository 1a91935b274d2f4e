"""Daily executive snapshot: one row per active client and cut-off."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigia import business as B
from vigia.calendar import DailyCutoff
from vigia.functions.dates import after_until, day, from_until
from vigia.functions.numbers import per_hundred
from vigia.operators.latest import latest

# Words of the classification and its cuts, in cases per 100 workers.
CRITICAL, MODERATE, LOW, NO_DATA = "crítico", "moderado", "bajo", "sin dato"
CRITICAL_ABOVE = 5
MODERATE_FROM = 2

COLUMNS = (
    "fecha_corte", "id_cliente", "nombre", "sector", "clase_riesgo", "casos_mes", "graves_mes",
    "casos_mes_ant_mismo_corte", "variacion_casos", "variacion_casos_pct", "casos_mes_ant_completo",
    "periodo_trabajadores", "trabajadores_activos", "tasa_incidencia",
    "actividades_prevencion_30d", "participantes_prevencion_30d", "clasificacion", "fecha_proceso",
)


def daily_snapshot(
    clientes: DataFrame,
    casos: DataFrame,
    facturacion: DataFrame,
    prevencion: DataFrame,
    cutoff: DailyCutoff,
) -> DataFrame:
    """Month to date against the same stretch of the previous month, rate and class."""
    occurred = F.col("fecha_ocurrencia")
    this_month = from_until(occurred, cutoff.month_start, cutoff.day)
    cases = (
        casos.filter(from_until(occurred, cutoff.previous_month_start, cutoff.day))
        .groupBy("id_cliente")
        .agg(
            F.count_if(this_month).alias("casos_mes"),
            F.count_if(this_month & (F.col("tipo") == B.SERIOUS)).alias("graves_mes"),
            F.count_if(from_until(occurred, cutoff.previous_month_start, cutoff.previous_cutoff))
            .alias("casos_mes_ant_mismo_corte"),
            F.count_if(from_until(occurred, cutoff.previous_month_start, cutoff.previous_month_end))
            .alias("casos_mes_ant_completo"),
        )
    )
    workers = latest(
        facturacion.filter(F.col("periodo") <= day(cutoff.month_start)), "id_cliente", "periodo",
        {"periodo_trabajadores": "periodo", "trabajadores_activos": "trabajadores_activos"})
    visits = (
        prevencion.filter(after_until(F.col("fecha"), cutoff.days_before(30), cutoff.day))
        .groupBy("id_cliente")
        .agg(
            F.count(F.lit(1)).alias("actividades_prevencion_30d"),
            F.sum("participantes").alias("participantes_prevencion_30d"),
        )
    )
    zero_when_absent = (
        "casos_mes", "graves_mes", "casos_mes_ant_mismo_corte", "casos_mes_ant_completo",
        "actividades_prevencion_30d", "participantes_prevencion_30d",
    )
    base = (
        clientes.filter(F.col("estado") == B.ACTIVE)
        .select("id_cliente", "nombre", "sector", "clase_riesgo")
        .join(cases, "id_cliente", "left")
        .join(workers, "id_cliente", "left")
        .join(visits, "id_cliente", "left")
        .withColumns({name: F.coalesce(name, F.lit(0)) for name in zero_when_absent})
        .withColumn("_tasa", per_hundred(F.col("casos_mes"), F.col("trabajadores_activos")))
        .withColumn("variacion_casos", F.col("casos_mes") - F.col("casos_mes_ant_mismo_corte"))
    )
    rate = F.col("_tasa")
    return base.withColumns(
        {
            "fecha_corte": day(cutoff.day),
            "variacion_casos_pct": F.round(
                per_hundred(F.col("variacion_casos"), F.col("casos_mes_ant_mismo_corte")), 1),
            "tasa_incidencia": F.round(rate, 2),
            # By the unrounded rate: exactly 5 is still moderate.
            "clasificacion": F.when(rate.isNull(), NO_DATA)
            .when(rate > CRITICAL_ABOVE, CRITICAL)
            .when(rate >= MODERATE_FROM, MODERATE)
            .otherwise(LOW),
            "fecha_proceso": F.current_timestamp(),
        }
    ).select(*COLUMNS)
