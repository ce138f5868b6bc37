"""Treatment interruption and other losses (TX_ML)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.dates import lit_date
from kalulu.operators.bands import age_band, age_labels
from kalulu.operators.counts import WEIGHTED, group_weights, report_counts
from kalulu.operators.ranges import any_date_between, sorted_dates
from kalulu.params import ReportParams
from kalulu.plans.cohort import facilities, hiv_cohort
from kalulu.plans.reports.common import order_report
from kalulu.sources.fixtures import Warehouse


def with_iit_flags(rows: DataFrame, wh: Warehouse, cutoff: int) -> DataFrame:
    """For each row's last appointment: does SOME initial visit of the patient
    lie <= 90, within 90..179, or >= 180 days before appointment + cutoff?

    A patient's initial visits are one sorted array of dates, joined by
    patient; rows stay as many as they are and each searches the array.
    """
    ini = sorted_dates(wh.mw_art_initial.select("patient_id", "visit_date"), "patient_id", "visit_date", "__initial")

    def before(days: int) -> str:
        return f"date_add(last_appt_date, {cutoff - days})"

    return rows.join(ini, "patient_id", "left").withColumns({
        "iit_short": F.expr(f"get(__initial, size(__initial) - 1) >= {before(K.IIT_SHORT_DAYS)}"),
        "iit_mid": any_date_between("__initial", before(K.IIT_LONG_DAYS - 1), before(K.IIT_SHORT_DAYS)),
        "iit_long": F.expr(f"get(__initial, 0) <= {before(K.IIT_LONG_DAYS)}"),
    }).drop("__initial")


def tx_ml_indicators(p: ReportParams) -> dict[str, Column]:
    in_period = F.col("start_date").between(lit_date(p.start), lit_date(p.end))
    lost = (((F.col("state") == K.DEFAULTED) & in_period)
            | ((F.col("state") == K.ON_ART) & (F.datediff(lit_date(p.end), F.col("last_appt_date")) >= p.cutoff)))

    def flag(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(False))

    return {
        "Died": (F.col("state") == K.DIED) & in_period,
        "IIT_3mo_or_less_mo": lost & flag("iit_short"),
        "IIT_3to5_mo": lost & flag("iit_mid"),
        "IIT_6plus_mo": lost & flag("iit_long"),
        "Transferred_out": (F.col("state") == K.TRANSFERRED_OUT) & in_period,
        "Refused_Stopped": (F.col("state") == K.STOPPED) & in_period,
    }


def tx_ml(wh: Warehouse, start: _dt.date, end: _dt.date, location: str | None = None,
          cutoff: int = K.PEPFAR_CUTOFF_DAYS) -> DataFrame:
    p = ReportParams(start=start, end=end, location=location, cutoff=cutoff)
    # detail rows: the distinct rows per ARV Number (the cohort has a row for each of them); group rows: all cohort rows
    rows = hiv_cohort(wh, p).groupBy("patient_id", "identifier", "state", "start_date", "gender", "age", "location",
                                     "last_appt_date").agg(*group_weights("gender", "pregnant_or_lactating"))
    return order_report(report_counts(
        with_iit_flags(rows, wh, cutoff), facilities(wh, location), age_band("age", "gender"), "gender", WEIGHTED,
        tx_ml_indicators(p), age_labels()))
