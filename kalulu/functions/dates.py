"""Date arithmetic with the source system's semantics."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_text(d: _dt.date | str) -> str:
    return f"date '{d if isinstance(d, str) else d.isoformat()}'"


def lit_date(d: _dt.date | str) -> Column:
    return F.expr(date_text(d))


def age_in_units(as_of: Column, birthdate: Column, divider: int) -> Column:
    """floor(datediff(as_of, birthdate) / divider) as an integer."""
    return F.floor(F.datediff(as_of, birthdate) / F.lit(divider)).cast("int")


def report_date_label(d: Column) -> Column:
    """dd-MMM-yy, e.g. 05-Apr-00."""
    return F.date_format(d, "dd-MMM-yy")


def months_between_completed(a: Column, b: Column) -> Column:
    """Signed whole months from a to b, truncated toward zero (TIMESTAMPDIFF MONTH)."""
    raw = (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))
    adj = (F.when((b >= a) & (F.dayofmonth(b) < F.dayofmonth(a)), -1)
           .when((b < a) & (F.dayofmonth(b) > F.dayofmonth(a)), 1).otherwise(0))
    return (raw + adj).cast("int")
