"""Cohort disaggregated (TX_CURR and current regimen), MOH (cutoff 60) and
PEPFAR (cutoff 30) flavours."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.dates import date_text, lit_date
from kalulu.functions.sqltext import quoted
from kalulu.operators.bands import age_band, age_labels
from kalulu.operators.counts import group_label, report_counts
from kalulu.params import ReportParams
from kalulu.plans.cohort import facilities, hiv_cohort
from kalulu.plans.reports.common import order_report
from kalulu.sources.fixtures import Warehouse


def is_active(p: ReportParams, state: str = "state", appt: str = "last_appt_date") -> Column:
    """On ART and the last appointment at most ``cutoff`` days before the end date
    (a null appointment is never active)."""
    return (F.col(state) == K.ON_ART) & (F.datediff(lit_date(p.end), F.col(appt)) <= p.cutoff)


def cohort_indicators(p: ReportParams) -> dict[str, Column]:
    active = f"state = {quoted(K.ON_ART)} and datediff({date_text(p.end)}, last_appt_date) <= {p.cutoff}"
    return {"tx_curr": is_active(p)} | {code: F.expr(f"{active} and current_regimen = {quoted(text)}") for code, text in K.REGIMENS}


def cohort_disaggregated(wh: Warehouse, start: _dt.date, end: _dt.date, location: str | None = None,
                         cutoff: int = K.MOH_CUTOFF_DAYS) -> DataFrame:
    p = ReportParams(start=start, end=end, location=location, cutoff=cutoff)
    groups = {group_label("gender", "pregnant_or_lactating"): "1"}
    return order_report(report_counts(hiv_cohort(wh, p), facilities(wh, p.location), age_band("age", "gender"), "gender", groups,
                                      cohort_indicators(p), age_labels()))
