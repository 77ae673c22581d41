"""Calendar expressions: Sunday-based weeks, half years, ISO weeks and week cycles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sunday_week(day: Column | str) -> Column:
    """Week of the year, 0..53, weeks starting on Sunday (the C library's ``%U``)."""
    weekday = F.dayofweek(day) - 1
    return F.floor((F.dayofyear(day) + 6 - weekday) / 7).cast("int")


def half_year(day: Column | str, last_month: int = 5) -> Column:
    """1 up to ``last_month``, then 2. The stored calendar counts June in half 2, hence 5."""
    return F.when(F.month(day) <= last_month, 1).otherwise(2)


def week_cycle(day: Column, first_year: Column) -> Column:
    """1 inside the first calendar year seen, 2 from then on.

    The last days of December may already belong to ISO week 1; in the first year they
    count as cycle 2, so that they follow week 52 instead of preceding week 2.
    """
    rolled_over = (F.month(day) == 12) & (F.weekofyear(day) == 1)
    return F.when((F.year(day) == first_year) & ~rolled_over, 1).otherwise(2)


def previous_week(week: Column | str) -> Column:
    """The week before, week 1 being preceded by week 52."""
    week = F.col(week) if isinstance(week, str) else week
    return F.when(week == 1, 52).otherwise(week - 1)
