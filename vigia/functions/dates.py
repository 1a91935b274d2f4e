"""Date columns and literals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def day(value: date) -> Column:
    return F.lit(value)


def month_of(column: Column) -> Column:
    return F.trunc(column, "MM")


def after_until(column: Column, start: date, end: date) -> Column:
    """start < column <= end"""
    return (column > day(start)) & (column <= day(end))


def from_until(column: Column, start: date, end: date) -> Column:
    """start <= column <= end"""
    return (column >= day(start)) & (column <= day(end))


def from_before(column: Column, start: date, end: date) -> Column:
    """start <= column < end"""
    return (column >= day(start)) & (column < day(end))


def months_between(start: date, end: date) -> Column:
    """Array of the first days of month from ``start`` to ``end``, both included."""
    return F.sequence(day(start), day(end), F.expr("interval 1 month"))
