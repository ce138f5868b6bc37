"""Report parameters and reporting-period arithmetic."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalulu import constants as K


def _add_months(d: _dt.date, months: int) -> _dt.date:
    """Calendar month shift clamped to the month end (MySQL / Spark add_months)."""
    y, m = divmod(d.month - 1 + months, 12)
    y, m = d.year + y, m + 1
    last = (_dt.date(y + (m == 12), m % 12 + 1, 1) - _dt.timedelta(days=1)).day
    return _dt.date(y, m, min(d.day, last))


# Day-of-month of the end date -> days added back after subtracting the span.
# Any other day makes the period start equal to the end date itself.
_PAD_BY_DAY = {28: 4, 29: 3, 30: 2, 31: 1}


def period_start(end: _dt.date, days: int = 0, months: int = 0) -> _dt.date:
    """Start of a reporting period that ends on ``end``.

    ``end - span + pad`` where pad depends on the day of month of ``end``
    (28 -> 4, 29 -> 3, 30 -> 2, 31 -> 1); other days return ``end``.
    """
    pad = _PAD_BY_DAY.get(end.day)
    if pad is None:
        return end
    base = _add_months(end, -months) if months else end
    return base - _dt.timedelta(days=days) + _dt.timedelta(days=pad)


def period_start_col(end: Column, days: int = 0, months: int = 0) -> Column:
    """Column version of :func:`period_start` (one pass over a period table)."""
    base = F.add_months(end, -months) if months else end
    shifted = F.date_sub(base, days) if days else base
    dom = F.dayofmonth(end)
    expr = None
    for day, pad in _PAD_BY_DAY.items():
        branch = F.date_add(shifted, pad)
        expr = F.when(dom == day, branch) if expr is None else expr.when(dom == day, branch)
    return expr.otherwise(end)


@dataclass(frozen=True)
class ReportParams:
    """Parameters of one reporting run.

    ``location=None`` computes every facility in one job; a facility name
    restricts the job to that facility (a pushed-down filter).
    """

    start: _dt.date
    end: _dt.date
    location: str | None = None
    cutoff: int = K.MOH_CUTOFF_DAYS
    divider: int = K.BIRTHDATE_DIVIDER

    def with_(self, **kw) -> "ReportParams":
        return replace(self, **kw)


def d(s: str) -> _dt.date:
    return _dt.date.fromisoformat(s)
