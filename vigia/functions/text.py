"""Reading of free-text billing fields.

Only spellings with a single meaning are read; anything else becomes NULL.
The readers expect text already passed through ``strip``: keep the stripped
text in a column of its own, so that it is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spanish names and short forms of the twelve months.
MONTH_NAMES = (
    ("enero", "ene"), ("febrero", "feb"), ("marzo", "mar"), ("abril", "abr"),
    ("mayo", "may"), ("junio", "jun"), ("julio", "jul"), ("agosto", "ago"),
    ("septiembre", "sep", "set"), ("octubre", "oct"), ("noviembre", "nov"), ("diciembre", "dic"),
)

# Accepted shapes of a period besides year-month-day, and how each is rewritten
# as year-month-day. The shapes exclude one another.
PERIOD_SHAPES = (
    (r"^(\d{4})[-/](\d{1,2})$", "$1-$2-1"),
    (r"^(\d{1,2})(?:[-/]|\s+)(\d{4})$", "$2-$1-1"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1"),
    (r"^(\d{4})(\d{1,2})$", "$1-$2-1"),
)
YEAR_MONTH_DAY = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"

CLIENT = r"^(?:CLI)?[-_ ]?0*([1-9]\d{0,5})$"
NUMBER = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf(?:inity)?))$"
# Blank characters at either end, control separators and no-break spaces included.
EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(column: Column) -> Column:
    return F.regexp_replace(F.coalesce(column, F.lit("")), EDGES, "")


def client_id(text: Column) -> Column:
    """``cli-12``, ``CLI0012``, ``12`` → ``CLI-0012``; client 0 does not exist."""
    upper = F.upper(text)
    digits = F.regexp_extract(upper, CLIENT, 1).try_cast("int")
    return F.when(upper.rlike(CLIENT), F.format_string("CLI-%04d", digits))


def _month_names_to_numbers(text: Column) -> Column:
    for number, names in enumerate(MONTH_NAMES, start=1):
        text = F.regexp_replace(text, rf"(?U)^(?:{'|'.join(names)})\b", f"{number:02d}")
    return text


def period(text: Column) -> Column:
    """First day of the month named by the text; 01/08/2026 is in August."""
    lower = F.lower(text)
    rewritten = F.when(lower.rlike("^[a-z]"), _month_names_to_numbers(lower)).otherwise(lower)
    for shape, target in PERIOD_SHAPES:
        rewritten = F.regexp_replace(rewritten, shape, target)
    return F.trunc(F.try_to_date(F.regexp_extract(rewritten, YEAR_MONTH_DAY, 0), "yyyy-M-d"), "MM")


def number(text: Column) -> Column:
    """Plain or scientific number; currency signs and thousands marks are not guessed."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))
