"""Traffic light and suggested action as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vigia import business as B

# Texts of the suggested action.
VISIT = "Agendar visita de prevención esta semana"
REVIEW_SERIOUS = "Revisar casos graves con el cliente"
PLAN_PREVENTION = "Programar prevención (riesgo alto sin actividad)"
FOLLOW_UP = "Seguimiento: tasa sobre la meta"
NO_ACTION = "Sin acción inmediata"


def compliance(real: Column, target: Column, lower_is_better: bool = True) -> Column:
    """Share of the target reached, at most 1; NULL when either side is missing."""
    if lower_is_better:
        reached = F.when(real <= target, F.lit(1.0)).otherwise(target / F.nullif(real, F.lit(0.0)))
    else:
        reached = F.least(real / F.nullif(target, F.lit(0.0)), F.lit(1.0))
    return F.when(real.isNotNull() & target.isNotNull(), reached)


def light(reached: Column) -> Column:
    return (
        F.when(reached.isNull(), F.lit(B.NO_DATA))
        .when(reached >= B.GREEN_FROM, F.lit(B.GREEN))
        .when(reached >= B.AMBER_FROM, F.lit(B.AMBER))
        .otherwise(F.lit(B.RED))
    )


def traffic_light(real: Column, target: Column, lower_is_better: bool = True) -> tuple[Column, Column]:
    """(status, compliance)"""
    reached = compliance(real, target, lower_is_better)
    return light(reached), reached


def whole_percent(reached: Column) -> Column:
    """Rounded down: 99.97 % of a target is shown as 99, not as reached."""
    return F.floor(reached * 100).cast("int")


def status_rank(status: Column) -> Column:
    """Position from worst to best, for sorting."""
    rank = F.when(status == B.STATUS_ORDER[0], 0)
    for position, word in enumerate(B.STATUS_ORDER[1:], start=1):
        rank = rank.when(status == word, position)
    return rank


def high_risk(risk_class: Column) -> Column:
    return risk_class.isin(*B.HIGH_RISK_CLASSES)


def suggested_action(status: Column, risk_class: Column, serious: Column, visits: Column) -> Column:
    """First rule that applies wins."""
    unvisited = visits == 0
    return (
        F.when((status == B.RED) & unvisited, F.lit(VISIT))
        .when(serious > 0, F.lit(REVIEW_SERIOUS))
        .when(high_risk(risk_class) & unvisited, F.lit(PLAN_PREVENTION))
        .when(status == B.RED, F.lit(FOLLOW_UP))
        .otherwise(F.lit(NO_ACTION))
    )
