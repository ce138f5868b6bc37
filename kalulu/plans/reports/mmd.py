"""Multi-month dispensing (TX_MMD): patients on ART and active at the facility,
by dispensing interval of their latest follow-up visit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.dates import lit_date
from kalulu.operators.bands import age_band, age_labels
from kalulu.operators.counts import WEIGHTED, group_weights, report_counts
from kalulu.params import ReportParams, period_start
from kalulu.plans.cohort import facilities, hiv_cohort
from kalulu.plans.reports.common import latest_followup, order_report
from kalulu.sources.fixtures import Warehouse


def mmd_indicators() -> dict:
    days = F.col("days_diff")
    return {
        "less_than_three_months": days < K.MMD_LOW_DAYS,
        "three_to_five_months": days.between(K.MMD_LOW_DAYS, K.MMD_HIGH_DAYS),
        "six_months_plus": days > K.MMD_HIGH_DAYS,
    }


def mmd_rows(wh: Warehouse, p: ReportParams) -> DataFrame:
    """Latest follow-up rows of patients on ART at the facility whose
    appointment is at most ``cutoff`` days before the end date, with how many
    cohort rows of each population group the patient has there.

    The patients, their sex and their age at the end date (that of the cohort
    while on ART) come from the one cohort of the report.
    """
    on_art = hiv_cohort(wh, p).where(F.col("state") == K.ON_ART).groupBy("patient_id", "location", "gender", "age").agg(
        *group_weights("gender", "pregnant_or_lactating"))
    fu = latest_followup(wh, p).where(F.datediff(lit_date(p.end), F.col("next_appointment_date")) <= p.cutoff).select(
        "patient_id", F.datediff("next_appointment_date", "visit_date").alias("days_diff"))
    return fu.join(on_art, "patient_id")


def tx_mmd(wh: Warehouse, end, location: str | None = None,
           cutoff: int = K.MOH_CUTOFF_DAYS) -> DataFrame:
    """Detail rows by age band x sex + the four group rows, per facility."""
    p = ReportParams(start=period_start(end, days=90), end=end, location=location, cutoff=cutoff)
    return order_report(report_counts(mmd_rows(wh, p), facilities(wh, p.location), age_band("age", "gender"), "gender", WEIGHTED,
                                      mmd_indicators(), age_labels()))
