"""Risk and cost per active client: the current definition, the inherited one, and the audit between them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from vigia import business as B
from vigia.calendar import ClosedMonths, shift_months
from vigia.functions.dates import day, from_before
from vigia.functions.numbers import per_hundred, ratio
from vigia.operators.fanout import join_fanout
from vigia.operators.ranking import dense_rank_desc

COLUMNS = (
    "id_cliente", "nombre", "clase_riesgo", "total_casos", "casos_graves", "costo_total",
    "trabajadores_prom", "pct_graves", "costo_x_trab", "ranking_clase",
)


def _finish(base: DataFrame) -> DataFrame:
    rated = base.withColumns(
        {
            "pct_graves": F.round(per_hundred(F.col("casos_graves"), F.col("total_casos")), 1),
            "costo_x_trab": F.round(ratio(F.col("costo_total"), F.col("trabajadores_prom")), 0),
        }
    )
    ranked = dense_rank_desc(rated, "clase_riesgo", "costo_total", "ranking_clase")
    return ranked.select(*COLUMNS)


def _active(clientes: DataFrame) -> DataFrame:
    return clientes.filter(F.col("estado") == B.ACTIVE).select("id_cliente", "nombre", "clase_riesgo")


def client_risk_cost(
    clientes: DataFrame,
    casos: DataFrame,
    facturacion: DataFrame,
    months: ClosedMonths,
) -> DataFrame:
    """Cases, serious share, cost and cost per worker of the closed months, ranked within the class.

    Each fact is brought to one row per client before it is joined.
    """
    cases = (
        casos.filter(from_before(F.col("fecha_ocurrencia"), months.start, months.end))
        .groupBy("id_cliente")
        .agg(
            F.count(F.lit(1)).alias("total_casos"),
            F.count_if(F.col("tipo") == B.SERIOUS).alias("casos_graves"),
            F.sum("costo").alias("costo_total"),
        )
    )
    workers = (
        facturacion.filter(from_before(F.col("periodo"), months.start, months.end))
        .groupBy("id_cliente")
        .agg(F.avg(F.col("trabajadores_activos").cast("decimal(18,2)")).alias("trabajadores_prom"))
    )
    base = _active(clientes).join(cases, "id_cliente").join(workers, "id_cliente", "left")
    return _finish(base).orderBy(F.desc("clase_riesgo"), "ranking_clase", "id_cliente")


def _legacy_cases(casos: DataFrame, as_of: date) -> DataFrame:
    return casos.filter(F.col("fecha_ocurrencia") >= day(shift_months(as_of, -12)))


def _legacy_billing(facturacion: DataFrame, as_of: date) -> DataFrame:
    return facturacion.filter(F.col("periodo") >= day(shift_months(as_of, -6)))


def client_risk_cost_legacy(
    clientes: DataFrame,
    casos: DataFrame,
    facturacion: DataFrame,
    as_of: date,
) -> DataFrame:
    """The inherited figures, kept to explain old reports.

    It joined twelve months of cases with six months of billing before grouping, so
    every case of a client counts once per billed month; it called a case serious
    after 15 days of absence and averaged workers in whole numbers. Counts, sums and
    the mean of such a product follow from the two sides: each case measure times
    the number of billed months. The product itself is never built.
    """
    cases = (
        _legacy_cases(casos, as_of)
        .groupBy("id_cliente")
        .agg(
            F.count("id_caso").alias("_casos"),
            F.count_if(F.col("dias_ausencia") > 15).alias("_graves"),
            F.sum("costo").alias("_costo"),
        )
        .filter(F.col("_casos") > 0)
    )
    billing = (
        _legacy_billing(facturacion, as_of)
        .groupBy("id_cliente")
        .agg(
            F.count(F.lit(1)).alias("_meses"),
            F.avg("trabajadores_activos").cast("int").alias("trabajadores_prom"),
        )
    )
    times = F.coalesce("_meses", F.lit(1))
    base = (
        _active(clientes).join(cases, "id_cliente").join(billing, "id_cliente", "left")
        .select(
            "id_cliente", "nombre", "clase_riesgo",
            (F.col("_casos") * times).alias("total_casos"),
            (F.col("_graves") * times).alias("casos_graves"),
            (F.col("_costo") * times.cast("decimal(10,0)")).cast("decimal(38,2)").alias("costo_total"),
            "trabajadores_prom",
        )
    )
    return _finish(base).orderBy(F.desc_nulls_last("costo_total"), "id_cliente")


def legacy_fanout(clientes: DataFrame, casos: DataFrame, facturacion: DataFrame, as_of: date) -> DataFrame:
    """Cases the inherited join counted against the cases there are, for active clients."""
    active = _active(clientes).select("id_cliente")
    return join_fanout(
        _legacy_cases(casos, as_of), _legacy_billing(facturacion, as_of), "id_cliente", only=active)
