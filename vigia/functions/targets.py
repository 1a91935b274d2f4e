"""Targets as columns. Sums stay exact: the class target is a decimal and so is its sum."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vigia.business import Targets

RATE = "decimal(9,4)"


def class_target(risk_class: Column, targets: Targets) -> Column:
    """Rate target of a risk class; NULL for a class without one."""
    chosen = None
    for number, rate in sorted(targets.rate_by_class.items()):
        value = F.lit(str(rate)).cast(RATE)
        chosen = (
            F.when(risk_class == number, value) if chosen is None else chosen.when(risk_class == number, value)
        )
    return F.lit(None).cast(RATE) if chosen is None else chosen


def expected_cases(workers: Column, risk_class: Column, targets: Targets) -> Column:
    """Aggregate: cases the target allows for the workers of a group, Σ workers × target / 100."""
    return F.sum(workers.cast("decimal(20,0)") * class_target(risk_class, targets)).cast("double") / F.lit(100.0)
