"""Snapshot-date expressions: period keys, windows, lifecycle routing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark import fixed_values as fv

PERIOD = "yyyy_MM_dd"


def month_start(when: Column) -> Column:
    return F.trunc(when.cast("date"), "month")


def period_key(day: Column) -> Column:
    return F.date_format(day, PERIOD)


def day_of_period(key: Column) -> Column:
    return F.try_to_date(key, PERIOD)


def period_in_path(path: Column) -> Column:
    """The trailing ``Y_m_d`` of a file or folder name as a date."""
    return day_of_period(F.regexp_extract(path, r"(\d{4}_\d{2}_\d{2})(?:\.[a-z]+)?/?$", 1))


def week_before(day: Column) -> Column:
    return F.date_sub(day, 7)


def week_after(day: Column) -> Column:
    return F.date_add(day, 7)


def training_window(day: Column, months: int = 12) -> Column:
    """The ``months`` month dates that end one month before ``day``."""
    return F.sequence(F.add_months(day, -months), F.add_months(day, -1), F.expr("interval 1 month"))


def trailing_weeks(day: Column, weeks: int) -> Column:
    """``weeks`` weekly dates, the last being ``day``."""
    return F.sequence(F.date_sub(day, 7 * (weeks - 1)), day, F.expr("interval 7 days"))


def every_day(start: Column, end: Column) -> Column:
    return F.sequence(start, end, F.expr("interval 1 day"))


def lifecycle_phase(day: Column) -> Column:
    start = F.lit(fv.INITIAL_TRAINING_DATE).cast("date")
    return (
        F.when(day < start, fv.PHASE_SKIP)
        .when(day == start, fv.PHASE_INITIAL)
        .otherwise(fv.PHASE_MONTHLY)
    )


def retraining_decision(day: Column) -> Column:
    dates = [F.lit(d).cast("date") for d in fv.RETRAIN_DATES]
    return F.when(day.isin(*dates), fv.RETRAIN).otherwise(fv.NO_RETRAIN)


def loads_static(day: Column) -> Column:
    return (day == F.lit(fv.STATIC_LOAD_DATE).cast("date")).cast("int")
