"""TB screening (TX_TB) and hypertension (TX_HIV_HTN) among patients on ART."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.dates import lit_date
from kalulu.operators.bands import age_band, age_labels
from kalulu.operators.counts import WEIGHTED, group_weights, report_counts
from kalulu.params import ReportParams, period_start
from kalulu.plans.cohort import facilities, hiv_cohort, identifier_flags
from kalulu.plans.reports.cohort_disaggregated import is_active
from kalulu.plans.reports.common import order_report
from kalulu.sources.fixtures import Warehouse


def _only_here() -> Column:
    return F.coalesce(F.col("only_here"), F.lit(False))


def _new_here(p: ReportParams) -> Column:
    return (F.col("initial_visit_date").between(lit_date(p.start), lit_date(p.end))
            & F.col("transfer_in_date").isNull() & _only_here())


def tx_tb_indicators(p: ReportParams) -> dict[str, Column]:
    tb = F.col("tb_status")
    prev = F.col("initial_visit_date") < lit_date(p.start)
    zero = F.lit(False)
    return {
        "tx_curr": is_active(p),
        "symptom_screen_alone": tb.isin(K.TB_STATUSES),
        "cxr_screen": zero,
        "mwrd_screen": zero,
        "screened_for_tb_tx_new_pos": (tb == K.TB_SUSPECTED) & _new_here(p),
        "screened_for_tb_tx_new_neg": (tb == K.TB_NOT_SUSPECTED) & _new_here(p),
        "screened_for_tb_tx_prev_pos": (tb == K.TB_SUSPECTED) & prev,
        "screened_for_tb_tx_prev_neg": (tb == K.TB_NOT_SUSPECTED) & prev,
        "tb_rx_new": (tb == K.TB_ON_TREATMENT) & _new_here(p),
        "tb_rx_prev": (tb == K.TB_NOT_ON_TREATMENT) & prev,
    }


def _screening_counts(wh: Warehouse, p: ReportParams, cohort: DataFrame, columns: list[str], indicators: dict[str, Column]) -> DataFrame:
    """Detail rows count the distinct projection of the cohort on ``columns``, group
    rows every cohort row: one row per distinct projection carries how many
    cohort rows of each group it stands for.  The programme and state id of
    the procedures' rows depend on (patient, facility) and part none."""
    rows = cohort.groupBy(*columns).agg(*group_weights("gender", "pregnant_or_lactating"))
    rows = rows.join(identifier_flags(wh, p.location), ["patient_id", "location"], "left")
    return order_report(report_counts(rows, facilities(wh, p.location), age_band("age", "gender"), "gender", WEIGHTED,
                                      indicators, age_labels()))


def tx_tb(wh: Warehouse, end: _dt.date, location: str | None = None,
          cutoff: int = K.PEPFAR_CUTOFF_DAYS) -> DataFrame:
    p = ReportParams(start=period_start(end, days=90), end=end, location=location, cutoff=cutoff)
    cols = ["patient_id", "identifier", "state", "start_date", "gender", "age", "location", "last_appt_date",
            "followup_visit_date", "initial_visit_date", "transfer_in_date", "tb_status"]
    return _screening_counts(wh, p, hiv_cohort(wh, p, extra=("tb_status",)), cols, tx_tb_indicators(p))


def htn_indicators(p: ReportParams) -> dict[str, Column]:
    sbp, dbp = F.col("systolic_bp"), F.col("diastolic_bp")
    high = (sbp >= K.HTN_SYSTOLIC) | (dbp >= K.HTN_DIASTOLIC)
    fu_in = F.col("followup_visit_date").between(lit_date(p.start), lit_date(p.end))
    return {
        "tx_curr": is_active(p),
        "diagnosed_htn": high & _only_here(),
        "screened_for_htn": fu_in & _only_here() & (sbp.isNotNull() | dbp.isNotNull()),
        "newly_diagnosed": _new_here(p) & high,
        "controlled_htn": fu_in & _only_here() & (sbp < K.HTN_SYSTOLIC) & (dbp < K.HTN_DIASTOLIC),
    }


def tx_hiv_htn(wh: Warehouse, end: _dt.date, location: str | None = None,
               cutoff: int = K.PEPFAR_CUTOFF_DAYS) -> DataFrame:
    p = ReportParams(start=period_start(end, months=6), end=end, location=location, cutoff=cutoff)
    cols = ["patient_id", "identifier", "state", "start_date", "gender", "age", "location", "last_appt_date",
            "current_regimen", "pregnant_or_lactating", "initial_pregnant_or_lactating", "followup_visit_date",
            "initial_visit_date", "transfer_in_date", "systolic_bp", "diastolic_bp"]
    return _screening_counts(wh, p, hiv_cohort(wh, p), cols, htn_indicators(p))
