"""Date parameters of a run, computed once on the driver.

Every job receives literals from one of these objects, so a run has a single
cut-off however long it takes, and the literals reach the file scan as pushed
filters.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta


def month_start(day: date) -> date:
    return day.replace(day=1)


def month_end(day: date) -> date:
    return day.replace(day=calendar.monthrange(day.year, day.month)[1])


def shift_months(day: date, months: int) -> date:
    """Add months; a day past the end of the target month becomes its last day."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class ClosedMonths:
    """The closed months before the month of ``as_of``."""

    as_of: date
    months: int = 12

    @classmethod
    def today(cls) -> ClosedMonths:
        return cls(date.today())

    @property
    def end(self) -> date:
        """First day of the running month, which is left out."""
        return month_start(self.as_of)

    @property
    def start(self) -> date:
        return shift_months(self.end, -self.months)

    @property
    def last_month(self) -> date:
        return shift_months(self.end, -1)


@dataclass(frozen=True)
class DailyCutoff:
    """Month to date up to ``day`` and the stretch of the previous month it is compared with."""

    day: date

    @classmethod
    def yesterday(cls) -> DailyCutoff:
        return cls(date.today() - timedelta(days=1))

    @property
    def month_start(self) -> date:
        return month_start(self.day)

    @property
    def previous_month_start(self) -> date:
        return shift_months(self.month_start, -1)

    @property
    def previous_month_end(self) -> date:
        return month_end(self.previous_month_start)

    @property
    def previous_cutoff(self) -> date:
        """Same day of the previous month; the whole previous month on a month's last day."""
        if self.day == month_end(self.day):
            return self.previous_month_end
        return shift_months(self.day, -1)

    @property
    def previous_day(self) -> date:
        return self.day - timedelta(days=1)

    def days_before(self, days: int) -> date:
        return self.day - timedelta(days=days)


@dataclass(frozen=True)
class MonthWindow:
    """``months`` consecutive months ending with ``month`` (first days of month)."""

    month: date
    months: int = 24

    @property
    def start(self) -> date:
        return shift_months(self.month, 1 - self.months)

    @property
    def end(self) -> date:
        """First day of the month after the window."""
        return shift_months(self.month, 1)

    def first_days(self) -> list[date]:
        return [shift_months(self.start, i) for i in range(self.months)]
