"""Business constants. All are parameters of the jobs that use them; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# Monthly targets, traffic-light cuts and the classes counted as high risk.
RATE_TARGET_BY_CLASS = {
    1: Decimal("0.25"),
    2: Decimal("0.30"),
    3: Decimal("0.65"),
    4: Decimal("0.95"),
    5: Decimal("1.25"),
}
COST_PER_WORKER = Decimal("22000")
PREVENTION_COVERAGE = 0.90
GREEN_FROM = 1.00
AMBER_FROM = 0.80
HIGH_RISK_CLASSES = (4, 5)
RISK_CLASSES = (1, 2, 3, 4, 5)
HISTORY_MONTHS = 24

# Status words and their order from worst to best.
RED, AMBER, GREEN, NO_DATA = "rojo", "amarillo", "verde", "sin dato"
STATUS_ORDER = (RED, AMBER, GREEN, NO_DATA)

SERIOUS, MILD = "grave", "leve"
ACTIVE, OPEN = "activo", "abierto"


@dataclass(frozen=True)
class Targets:
    """Targets per worker, so that they hold for any subset of the portfolio."""

    rate_by_class: dict[int, Decimal] = field(default_factory=lambda: dict(RATE_TARGET_BY_CLASS))
    cost_per_worker: Decimal = COST_PER_WORKER
    coverage: float = PREVENTION_COVERAGE


@dataclass(frozen=True)
class PriorityWeights:
    """Weights of the five components of the visit priority, and the floor of its denominator."""

    incidence: float = 0.30
    severity: float = 0.25
    trend: float = 0.15
    risk: float = 0.15
    prevention: float = 0.15
    min_workers: int = 20
    never_visited_days: int = 365


@dataclass(frozen=True)
class BillingLimits:
    """Limits of the billing file rules."""

    max_reject_share: float = 0.20
    max_workers: int = 50_000
    max_contract: int = 5_000_000_000
    max_days_late: int = 60
