from __future__ import annotations

from datetime import date

import pytest
from hypothesis import given, strategies as st

from vigia.calendar import ClosedMonths, DailyCutoff, MonthWindow, month_end, shift_months


@pytest.mark.parametrize(
    ("day", "previous_cutoff"),
    [
        (date(2001, 6, 17), date(2001, 5, 17)),
        (date(2001, 2, 28), date(2001, 1, 31)),
        (date(2001, 3, 30), date(2001, 2, 28)),
        (date(2001, 3, 31), date(2001, 2, 28)),
        (date(2001, 4, 30), date(2001, 3, 31)),
        (date(2000, 3, 30), date(2000, 2, 29)),
        (date(2001, 1, 1), date(2000, 12, 1)),
    ],
)
def test_same_stretch_of_the_previous_month(day, previous_cutoff):
    assert DailyCutoff(day).previous_cutoff == previous_cutoff


def test_closed_months_leave_the_running_month_out():
    months = ClosedMonths(date(2026, 10, 1))
    assert (months.start, months.end, months.last_month) == (
        date(2025, 10, 1), date(2026, 10, 1), date(2026, 9, 1))


@given(st.dates(date(1950, 1, 1), date(2100, 12, 31)), st.integers(-60, 60))
def test_shift_months_clamps_to_the_month(day, months):
    moved = shift_months(day, months)
    assert (moved.year * 12 + moved.month) - (day.year * 12 + day.month) == months
    assert moved.day == min(day.day, month_end(moved).day)


def test_window_months():
    days = MonthWindow(date(2001, 2, 1), 3).first_days()
    assert days == [date(2000, 12, 1), date(2001, 1, 1), date(2001, 2, 1)]
