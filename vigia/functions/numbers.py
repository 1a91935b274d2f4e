"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient in double; NULL when the bottom is 0 or NULL."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def per_hundred(top: Column, bottom: Column) -> Column:
    """Times 100 before dividing, so that exact cuts such as 5 stay exact."""
    return (top.cast("double") * F.lit(100.0)) / F.nullif(bottom.cast("double"), F.lit(0.0))


def relative_change(now: Column, before: Column) -> Column:
    """Undefined when there is nothing before or it is 0."""
    return ratio(now - before, before)
