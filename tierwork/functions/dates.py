"""Fiscal periods, company weeks and reporting cut-offs, as expressions (no UDF)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FISCAL_SHIFT = 3  # fiscal period 01 is April


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def fiscal_to_calendar(fiscal_year: Column, period: Column) -> Column:
    """First day of the calendar month: period 01 is April of the year before, period 10 January of the year."""
    return F.add_months(F.make_date(fiscal_year - 1, F.lit(1), F.lit(1)), period + F.lit(FISCAL_SHIFT - 1))


def fiscal_year(col: Column) -> Column:
    return F.year(F.add_months(col, 12 - FISCAL_SHIFT))


def fiscal_period(col: Column) -> Column:
    return F.month(F.add_months(col, -FISCAL_SHIFT))


def month_sequence(start: Column, end: Column) -> Column:
    """Array with the first day of every month from ``start`` to ``end``, both included."""
    return F.sequence(month_start(start), month_start(end), F.expr("interval 1 month"))


def first_saturday(year: Column) -> Column:
    return F.next_day(F.date_sub(F.make_date(year, F.lit(1), F.lit(1)), 1), "SAT")


def company_year(col: Column) -> Column:
    """Weeks start on Saturday; days before the year's first Saturday belong to the year before."""
    return F.when(col < first_saturday(F.year(col)), F.year(col) - 1).otherwise(F.year(col))


def company_week(col: Column) -> Column:
    return (F.floor(F.datediff(col, first_saturday(company_year(col))) / 7) + 1).cast("int")


def company_week_start(col: Column) -> Column:
    return F.date_sub(col, F.dayofweek(col) % 7)


def nth_working_day(month: Column, n: int) -> Column:
    days = F.sequence(month_start(month), F.last_day(month), F.expr("interval 1 day"))
    return F.try_element_at(F.filter(days, lambda d: ~F.dayofweek(d).isin(1, 7)), F.lit(n))


def ledger_cut_off(as_of: Column, overrides: Mapping[dt.date, dt.date] | None = None, working_day: int = 10) -> Column:
    """Last ledger day to use: the previous month end, or the one before it until the n-th working day.

    ``overrides`` maps a month (its first day) to the date that replaces that month's n-th working day.
    """
    gate = nth_working_day(as_of, working_day)
    for month, day in (overrides or {}).items():
        gate = F.when(month_start(as_of) == F.lit(month), F.lit(day)).otherwise(gate)
    back = F.when(as_of < gate, F.lit(-2)).otherwise(F.lit(-1))
    return F.last_day(F.add_months(as_of, back))


def parse_date(col: Column, formats: Sequence[str]) -> Column:
    """First format that fits wins; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)).cast("date") for f in formats])


def period_bounds(period: str | None, full_year: bool, as_of: dt.date, grace_day: int = 10) -> tuple[dt.date, dt.date]:
    """Half-open [start, end) of ``yyyy-MM`` (or its whole year).

    Without a period: the current month after ``grace_day``, else the month before.
    """
    if period:
        year, month = int(period[:4]), int(period[5:7])
    elif as_of.day > grace_day:
        year, month = as_of.year, as_of.month
    else:
        year, month = (as_of.year, as_of.month - 1) if as_of.month > 1 else (as_of.year - 1, 12)
    if full_year:
        return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)
    return dt.date(year, month, 1), (dt.date(year, month + 1, 1) if month < 12 else dt.date(year + 1, 1, 1))


def in_period(col: Column, bounds: tuple[dt.date, dt.date]) -> Column:
    """Range test on the raw column, so that it can reach the scan."""
    return (col >= F.lit(bounds[0])) & (col < F.lit(bounds[1]))
