"""Dates and targets the registered queries run with."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal

from vigia.business import RATE_TARGET_BY_CLASS, Targets
from vigia.calendar import ClosedMonths, DailyCutoff

TODAY = date(2001, 7, 15)
CLOSED = ClosedMonths(TODAY)
MONTH = CLOSED.last_month
CUTOFF = DailyCutoff(date(2001, 6, 17))
LEGACY_TODAY = date(2001, 6, 17)
LOAD_DATE = date(2001, 7, 15)
LATE_LOAD_DATE = date(2001, 8, 31)
SECTORS = ("BUILDING", "MACHINERY", "HOUSEHOLD")
CLASSES = (2, 4, 5)
COORDINATOR = "NATION_7"
USER = "usuario 3"

# A second set of targets that the mapped data crosses in both directions.
NEAR_TARGETS = replace(
    Targets(),
    rate_by_class={k: v * Decimal("1.5") for k, v in RATE_TARGET_BY_CLASS.items()},
    cost_per_worker=Decimal("2640"),
    coverage=0.15,
)

# Targets as a business table: class 5 has none, class 6 has no clients.
STORED_TARGETS = [(1, Decimal("0.2")), (2, Decimal("0.31")), (3, Decimal("0.7")), (4, Decimal("1.1")), (6, Decimal("2"))]
