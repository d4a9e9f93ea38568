"""Date arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "QUARTER")


def quarter_end(start: Column) -> Column:
    """Last day of the quarter beginning at ``start``."""
    return F.date_sub(F.add_months(start, 3), 1)


def day_number(d: Column) -> Column:
    """Days since the epoch: an integer, so window frames can be stated in days."""
    return F.unix_date(d)


def iso_weekday(d: Column) -> Column:
    """Monday 1 … Sunday 7."""
    return F.weekday(d) + 1


def month_name(d: Column, padded: bool = False) -> Column:
    """Full month name; ``padded`` fills it with blanks to nine characters as some warehouses do."""
    name = F.date_format(d, "MMMM")
    return F.rpad(name, 9, " ") if padded else name


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3.6e9)


def elapsed_months(start: Column, end: Column) -> Column:
    """Whole 30-day months from start to end, at least one."""
    return F.greatest(F.lit(1), F.floor(F.datediff(end, start) / F.lit(30)).cast("int"))
