"""Weekly priority of prevention visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigia import business as B
from vigia.calendar import DailyCutoff
from vigia.functions.dates import after_until, day
from vigia.operators.latest import latest
from vigia.operators.ranking import percent_ranks

# Texts of the main reason.
REASON_INCIDENCE = "Incidencia alta para su tamaño"
REASON_SEVERITY = "Casos graves recientes o abiertos"
REASON_TREND = "Casos en aumento"
REASON_PREVENTION = "Sin prevención reciente"

RANKED = {
    "incidencia_90d": "p_incidencia",
    "severidad": "p_severidad",
    "tendencia": "p_tendencia",
    "dias_sin_prevencion": "p_prevencion",
}
# The columns of the published list, in its order.
TOP_COLUMNS = (
    "prioridad", "id_cliente", "nombre", "sector", "clase_riesgo", "trabajadores_activos",
    "casos_90d", "graves_90d", "graves_abiertos", "incidencia_90d", "casos_90d_previos",
    "ultima_prevencion", "dias_sin_prevencion", "score_prioridad", "motivo_principal",
)


def priority_metrics(
    clientes: DataFrame,
    facturacion: DataFrame,
    casos: DataFrame,
    prevencion: DataFrame,
    cutoff: DailyCutoff,
    weights: B.PriorityWeights = B.PriorityWeights(),
) -> DataFrame:
    """One row per active client: incidence, severity, trend and days without prevention."""
    corte, recent, older = cutoff.day, cutoff.days_before(90), cutoff.days_before(180)
    workers = latest(
        facturacion.filter((F.col("periodo") <= day(corte)) & (F.col("trabajadores_activos") > 0)),
        "id_cliente", "periodo", {"trabajadores_activos": "trabajadores_activos"})
    occurred, serious = F.col("fecha_ocurrencia"), F.col("tipo") == B.SERIOUS
    # Serious cases still open count whatever their age, so there is no lower date bound.
    cases = casos.filter(occurred <= day(corte)).groupBy("id_cliente").agg(
        F.count_if(occurred > day(recent)).alias("casos_90d"),
        F.count_if(after_until(occurred, older, recent)).alias("casos_90d_previos"),
        F.count_if((occurred > day(recent)) & serious).alias("graves_90d"),
        F.count_if((F.col("estado") == B.OPEN) & serious).alias("graves_abiertos"),
    )
    visits = prevencion.filter(F.col("fecha") <= day(corte)).groupBy("id_cliente").agg(
        F.max("fecha").alias("ultima_prevencion"))
    counts = ("casos_90d", "casos_90d_previos", "graves_90d", "graves_abiertos")
    joined = (
        clientes.filter(F.col("estado") == B.ACTIVE)
        .select("id_cliente", "nombre", "sector", "clase_riesgo")
        .join(workers, "id_cliente", "left")
        .join(cases, "id_cliente", "left")
        .join(visits, "id_cliente", "left")
        .withColumns({name: F.coalesce(name, F.lit(0)) for name in counts})
    )
    floor = F.greatest(F.coalesce("trabajadores_activos", F.lit(0)), F.lit(weights.min_workers))
    return joined.select(
        "id_cliente", "nombre", "sector", "clase_riesgo", "trabajadores_activos", *counts,
        "ultima_prevencion",
        (F.col("casos_90d") * F.lit(100.0) / floor.cast("double")).alias("incidencia_90d"),
        (F.col("graves_90d") + F.col("graves_abiertos")).alias("severidad"),
        ((F.col("casos_90d") + F.lit(1.0)) / (F.col("casos_90d_previos") + F.lit(1.0))).alias("tendencia"),
        F.coalesce(
            F.datediff(day(corte), "ultima_prevencion"), F.lit(weights.never_visited_days)
        ).alias("dias_sin_prevencion"),
    )


def priority_score(
    metrics: DataFrame,
    weights: B.PriorityWeights = B.PriorityWeights(),
) -> DataFrame:
    """Adds the percentile of each component and their weighted sum, between 0 and 1."""
    ranked = percent_ranks(metrics, RANKED).withColumn(
        "p_riesgo", (F.col("clase_riesgo") - 1) / F.lit(4.0))
    parts = (
        (weights.incidence, "p_incidencia"), (weights.severity, "p_severidad"),
        (weights.trend, "p_tendencia"), (weights.risk, "p_riesgo"),
        (weights.prevention, "p_prevencion"),
    )
    score = F.lit(parts[0][0]) * F.col(parts[0][1])
    for weight, name in parts[1:]:
        score = score + F.lit(weight) * F.col(name)
    return ranked.withColumn("score_prioridad", score)


def main_reason(weights: B.PriorityWeights = B.PriorityWeights()) -> Column:
    """The component in which the client stands worst; ties go to the heavier, then to the earlier one.

    The risk class does not compete: it is fixed and shown on its own.
    """
    candidates = (
        ("p_incidencia", weights.incidence, REASON_INCIDENCE),
        ("p_severidad", weights.severity, REASON_SEVERITY),
        ("p_tendencia", weights.trend, REASON_TREND),
        ("p_prevencion", weights.prevention, REASON_PREVENTION),
    )
    best = F.array_max(
        F.array(
            *[
                F.struct(
                    F.col(percentile).alias("percentil"), F.lit(weight).alias("peso"),
                    F.lit(-position).alias("orden"), F.lit(text).alias("motivo"))
                for position, (percentile, weight, text) in enumerate(candidates)
            ]
        )
    )
    return best.getField("motivo")


def priority_top(
    scored: DataFrame, n: int = 15, weights: B.PriorityWeights = B.PriorityWeights()
) -> DataFrame:
    """The ``n`` clients to visit first, each with the main reason.

    The limit comes before the numbering, so only ``n`` rows reach one task.
    """
    order = (F.desc("score_prioridad"), F.desc("graves_90d"), F.desc("casos_90d"), F.asc("id_cliente"))
    top = scored.orderBy(*order).limit(n)
    numbered = top.withColumn("prioridad", F.row_number().over(Window.orderBy(*order)))
    return (
        numbered.withColumn("motivo_principal", main_reason(weights))
        .withColumns(
            {
                "incidencia_90d": F.round("incidencia_90d", 2),
                "score_prioridad": F.round(F.col("score_prioridad") * 100, 1),
            }
        )
        .select(*TOP_COLUMNS)
        .orderBy("prioridad")
    )


def visit_priorities(
    clientes: DataFrame,
    facturacion: DataFrame,
    casos: DataFrame,
    prevencion: DataFrame,
    cutoff: DailyCutoff,
    n: int = 15,
    weights: B.PriorityWeights = B.PriorityWeights(),
) -> DataFrame:
    """The weekly list from the tables."""
    metrics = priority_metrics(clientes, facturacion, casos, prevencion, cutoff, weights)
    return priority_top(priority_score(metrics, weights), n, weights)
