"""Loan arithmetic: missed instalments, days past due, labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark import fixed_values as fv


def installments_missed(overdue: Column, due: Column) -> Column:
    """Overdue amount in instalments, rounded up; NULL when nothing was due."""
    return F.ceil(F.try_divide(overdue.cast("double"), due.cast("double"))).try_cast("int")


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(snapshot: Column, first_missed: Column, overdue: Column) -> Column:
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(0).cast("int")


def default_label(dpd: Column, threshold: int = fv.LABEL_DPD) -> Column:
    return F.when(dpd >= threshold, 1).otherwise(0)


def label_definition(dpd: int = fv.LABEL_DPD, mob: int = fv.LABEL_MOB) -> Column:
    return F.format_string("%ddpd_%dmob", F.lit(dpd), F.lit(mob))


def high_risk(grade: Column, grades=fv.HIGH_RISK_GRADES) -> Column:
    return F.coalesce(grade.isin(*grades), F.lit(False)).cast("int")
