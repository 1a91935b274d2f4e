"""Rate against target by segment, and how cases are distributed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from vigia import business as B
from vigia.calendar import MonthWindow, shift_months
from vigia.functions.dates import day, from_until
from vigia.functions.numbers import ratio
from vigia.functions.status import high_risk, traffic_light
from vigia.functions.targets import expected_cases
from vigia.operators.cardinality import one_per_key
from vigia.sources.star import StarTables


def rate_vs_target(
    star: StarTables,
    first: date,
    last: date,
    by: Sequence[str],
    targets: B.Targets = B.Targets(),
) -> DataFrame:
    """Workers, expected and real cases, rate, target and status per group over months ``first`` to ``last``.

    ``by`` mixes client columns and ``periodo``. Groups are those with billing: cases
    of a group without any are not shown. A repeated client fails the job.
    """
    by = list(by)
    own = [c for c in by if c != "periodo"]
    clients = star.clientes.select(*dict.fromkeys(["id_cliente", "clase_riesgo", *own]))
    months = from_until(F.col("periodo"), first, last)
    # Both facts shrink to the client (and month, if asked for) before they meet the clients.
    per_client = ["id_cliente", "periodo"] if "periodo" in by else ["id_cliente"]
    billed = (
        star.fact("facturacion").filter(months).groupBy(*per_client).agg(F.sum("trabajadores_activos").alias("_n"))
        .join(one_per_key(clients, "id_cliente"), "id_cliente")
        .groupBy(*by)
        .agg(
            F.sum("_n").alias("trabajadores"),
            expected_cases(F.col("_n"), F.col("clase_riesgo"), targets).alias("casos_meta"),
            F.lit(True).alias("_facturado"),
        )
    )
    happened = (
        star.fact("casos").filter(months).groupBy(*per_client).agg(F.count(F.lit(1)).alias("_n"))
        .join(clients.select(*dict.fromkeys(["id_cliente", *own])), "id_cliente")
        .groupBy(*by).agg(F.sum("_n").alias("casos"))
    )
    people = F.col("trabajadores").cast("double")
    # Stacked and summed instead of joined: a missing sector is a group like any other.
    rated = (
        billed.unionByName(happened, allowMissingColumns=True).groupBy(*by)
        .agg(
            F.sum("trabajadores").alias("trabajadores"), F.sum("casos_meta").alias("casos_meta"),
            F.coalesce(F.sum("casos"), F.lit(0)).alias("casos"), F.max("_facturado").alias("_facturado"),
        )
        .filter("_facturado")
        .withColumns(
            {
                "tasa": ratio(F.col("casos"), people) * 100,
                "meta_tasa": ratio(F.col("casos_meta"), people) * 100,
            }
        )
    )
    status, reached = traffic_light(F.col("tasa"), F.col("meta_tasa"))
    return rated.select(
        *by, "trabajadores", "casos_meta", "casos", "tasa", "meta_tasa",
        status.alias("estado"), reached.alias("cumplimiento"))


def sector_rate(star: StarTables, month: date, targets: B.Targets = B.Targets()) -> DataFrame:
    """Sectors of a month from the best to the worst compliance, unknown ones last."""
    return rate_vs_target(star, month, month, ["sector"], targets).orderBy(
        F.desc_nulls_last("cumplimiento"), "sector")


def sector_month(
    star: StarTables, month: date, months: int = 12, targets: B.Targets = B.Targets()
) -> DataFrame:
    """Sector × month, to tell a lasting problem from a single bad month."""
    return rate_vs_target(star, MonthWindow(month, months).start, month, ["sector", "periodo"], targets)


def sector_month_matrix(by_month: DataFrame, month: date, months: int = 12) -> DataFrame:
    """One row per sector with rate and status of each month in columns (``aaaa_mm_tasa``, ``aaaa_mm_estado``)."""
    labels = [f"{d:%Y_%m}" for d in MonthWindow(month, months).first_days()]
    return (
        by_month.withColumn("_mes", F.date_format("periodo", "yyyy_MM"))
        .groupBy("sector").pivot("_mes", labels)
        .agg(F.max("tasa").alias("tasa"), F.max("estado").alias("estado"))
        .orderBy("sector")
    )


def persistent_red(by_month: DataFrame, month: date, months: int = 3) -> DataFrame:
    """Sectors that are red in every month they appear in among the last ``months``."""
    return (
        by_month.filter((F.col("periodo") > day(shift_months(month, -months))) & (F.col("periodo") <= day(month)))
        .groupBy("sector")
        .agg(
            F.bool_and(F.col("estado") == B.RED).alias("_todos"),
            F.count(F.lit(1)).alias("meses"),
        )
        .filter("_todos").select("sector", "meses").orderBy("sector")
    )


def case_distribution(star: StarTables, month: date) -> DataFrame:
    """Cases of the month by risk class and type; the five classes are always there."""
    per_client = (
        star.fact("casos").filter(F.col("periodo") == day(month))
        .groupBy("id_cliente")
        .agg(
            F.count_if(F.col("tipo") == B.MILD).alias("leve"),
            F.count_if(F.col("tipo") == B.SERIOUS).alias("grave"),
        )
    )
    clients = one_per_key(star.clientes.select("id_cliente", "clase_riesgo"), "id_cliente")
    counted = (
        per_client.join(clients, "id_cliente").groupBy("clase_riesgo")
        .agg(F.sum("leve").alias("leve"), F.sum("grave").alias("grave"))
    )
    classes = star.clientes.sparkSession.range(B.RISK_CLASSES[0], B.RISK_CLASSES[-1] + 1).select(
        F.col("id").cast("int").alias("clase_riesgo"))
    return (
        classes.join(counted, "clase_riesgo", "left")
        .select(
            "clase_riesgo",
            F.coalesce("leve", F.lit(0)).alias("leve"),
            F.coalesce("grave", F.lit(0)).alias("grave"),
        )
        .orderBy("clase_riesgo")
    )


def case_mix(distribution: DataFrame) -> DataFrame:
    """Totals of a distribution, the serious share and the part of it in the high-risk classes."""
    totals = distribution.agg(
        F.sum("leve").alias("leve"),
        F.sum("grave").alias("grave"),
        F.coalesce(F.sum(F.when(high_risk(F.col("clase_riesgo")), F.col("grave"))), F.lit(0))
        .alias("grave_riesgo_alto"),
    )
    at_least_one = F.greatest(F.lit(1), F.col("leve") + F.col("grave"))
    return totals.select(
        "leve", "grave", "grave_riesgo_alto",
        ratio(F.col("grave"), at_least_one).alias("parte_grave"),
        ratio(F.col("grave_riesgo_alto"), F.greatest(F.lit(1), F.col("grave"))).alias("parte_grave_riesgo_alto"),
    )
