"""Clients of a month: summary with suggested action, and the lists made from it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from vigia import business as B
from vigia.calendar import MonthWindow, month_end
from vigia.functions.dates import day, from_until
from vigia.functions.numbers import ratio
from vigia.functions.status import (
    NO_ACTION, high_risk, status_rank, suggested_action, traffic_light)
from vigia.functions.targets import class_target
from vigia.operators.cardinality import one_per_key
from vigia.operators.spine import entity_months
from vigia.sources.star import StarTables

SUMMARY = (
    "id_cliente", "nombre", "sector", "clase_riesgo", "coordinador", "casos", "graves", "costo",
    "trabajadores", "tasa", "meta_tasa", "prevencion_mes", "dias_sin_prevencion", "estado", "accion",
)


def client_month_summary(star: StarTables, month: date, targets: B.Targets = B.Targets()) -> DataFrame:
    """One row per client with the figures of the month, its traffic light and a suggested action.

    A client that appears twice, or is billed twice in the month, fails the job.
    """
    closing = month_end(month)
    in_month = F.col("periodo") == day(month)
    clients = one_per_key(
        star.clientes.select("id_cliente", "nombre", "sector", "clase_riesgo", "coordinador"), "id_cliente")
    cases = star.casos.filter(in_month).groupBy("id_cliente").agg(
        F.count("id_caso").alias("casos"),
        F.count_if(F.col("tipo") == B.SERIOUS).alias("graves"),
        F.sum("costo").alias("costo"),
    )
    workers = one_per_key(
        star.facturacion.filter(in_month).select(
            "id_cliente", F.col("trabajadores_activos").alias("trabajadores")), "id_cliente")
    visits = star.prevencion.filter(F.col("fecha") <= day(closing)).groupBy("id_cliente").agg(
        F.max("fecha").alias("_ultima"), F.count_if(in_month).alias("prevencion_mes"))
    joined = (
        clients.join(cases, "id_cliente", "left").join(workers, "id_cliente", "left")
        .join(visits, "id_cliente", "left")
        .withColumns(
            {name: F.coalesce(name, F.lit(0)) for name in ("casos", "graves", "costo", "prevencion_mes")})
        .withColumns(
            {
                "tasa": ratio(F.col("casos"), F.col("trabajadores")) * 100,
                "meta_tasa": class_target(F.col("clase_riesgo"), targets).cast("double"),
                "dias_sin_prevencion": F.datediff(day(closing), "_ultima"),
            }
        )
    )
    return (
        joined.withColumn("estado", traffic_light(F.col("tasa"), F.col("meta_tasa"))[0])
        .withColumn(
            "accion",
            suggested_action(
                F.col("estado"), F.col("clase_riesgo"), F.col("graves"), F.col("prevencion_mes")))
        .select(*SUMMARY)
    )


def top_clients(summary: DataFrame, n: int = 10) -> DataFrame:
    """The clients with most cases, and whether each needs an action."""
    return (
        summary.orderBy(F.desc("casos"), F.desc("graves"), F.desc("costo"), "id_cliente").limit(n)
        .withColumn("requiere_accion", F.col("accion") != NO_ACTION)
    )


def worklist(summary: DataFrame, only_high_risk_unvisited: bool = False) -> DataFrame:
    """Clients from the worst to the best status, most cases first."""
    if only_high_risk_unvisited:
        summary = summary.filter(high_risk(F.col("clase_riesgo")) & (F.col("prevencion_mes") == 0))
    return summary.orderBy(status_rank(F.col("estado")), F.desc("casos"), "id_cliente")


def client_month_cases(star: StarTables, month: date) -> DataFrame:
    """Cases of the month, by client and date, with cost in millions."""
    return (
        star.casos.filter(F.col("periodo") == day(month))
        .select(
            "id_cliente", "id_caso", F.col("fecha_ocurrencia").alias("fecha"),
            F.initcap("tipo").alias("tipo"), "dias_ausencia",
            F.round(F.col("costo").cast("double") / 1e6, 2).alias("costo_millones"),
        )
        .orderBy("id_cliente", "fecha", "id_caso")
    )


def last_preventions(star: StarTables, month: date, k: int = 5) -> DataFrame:
    """Latest ``k`` activities of every client up to the end of the month.

    The rank filter is applied before the shuffle too (at most ``k`` rows per client
    and task survive), so a client with a third of all activities is no burden.
    """
    latest_first = Window.partitionBy("id_cliente").orderBy(
        F.desc("fecha"), F.asc("tipo"), F.desc("participantes"))
    return (
        star.prevencion.filter(F.col("fecha") <= day(month_end(month)))
        .select("id_cliente", "fecha", "tipo", "participantes")
        .withColumn("orden", F.row_number().over(latest_first))
        .filter(F.col("orden") <= k)
    )


def months_without_prevention(star: StarTables, month: date, months: int = 12) -> DataFrame:
    """Client and month pairs of the last months with no activity."""
    window = MonthWindow(month, months)
    visited = (
        star.prevencion.filter(from_until(F.col("periodo"), window.start, window.month))
        .select("id_cliente", "periodo").distinct()
    )
    return entity_months(star.clientes.select("id_cliente"), window).join(
        visited, ["id_cliente", "periodo"], "left_anti")
