"""Date expressions: range presets, month stepping, display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days behind the newest date, per preset; None means no start.
RANGE_DAYS = {"1M": 30, "3M": 91, "1Y": 365, "2Y": 730, "ALL": None}

# Display name per calendar preset.
RANGE_NAMES = {
    "1m": "1 Month",
    "3m": "3 Months",
    "1y": "1 Year",
    "2y": "2 Years",
    "3y": "3 Years",
    "all": "All Time",
}

DAYS_PER_YEAR = 365.25


def range_start(preset: str, newest: Column) -> Column | None:
    days = RANGE_DAYS[preset]
    return None if days is None else F.date_sub(newest, days)


def calendar_start(preset: str, today: Column) -> Column | None:
    """Start of a calendar preset: day presets count back, year presets begin
    on 1 January, an unknown preset on the first of the month before."""
    if preset == "all":
        return None
    if preset in ("1m", "3m"):
        return F.date_sub(today, {"1m": 30, "3m": 90}[preset])
    if preset in ("1y", "2y", "3y"):
        return F.make_date(F.year(today) - int(preset[0]), F.lit(1), F.lit(1))
    return F.trunc(F.add_months(today, -1), "MM")


def range_name(preset: str) -> str:
    """Display name of a calendar preset; an unknown one shows as one month."""
    return RANGE_NAMES.get(preset, RANGE_NAMES["1m"])


def month_step(start: Column, months: Column) -> Column:
    """Same day ``months`` later; a day the month lacks runs into the next one
    (31 January + 1 month = 2 or 3 March)."""
    first = F.add_months(F.trunc(start, "MM"), months)
    return F.date_add(first, F.dayofmonth(start) - 1)


def years_between(first: Column, last: Column) -> Column:
    return F.datediff(last, first) / F.lit(DAYS_PER_YEAR)


def display_date(day: Column) -> Column:
    return F.date_format(day, "MMM dd, yyyy")
