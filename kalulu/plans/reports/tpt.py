"""TB preventive therapy: MOH initiation report and PEPFAR TB_PREV."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.dates import date_text, lit_date
from kalulu.operators.bands import age_band, age_labels
from kalulu.operators.counts import WEIGHTED, group_label, group_weights, report_counts
from kalulu.params import ReportParams, period_start
from kalulu.plans.cohort import COHORT_COLUMNS, facilities, hiv_cohort
from kalulu.plans.reports.common import order_report
from kalulu.sources.fixtures import Warehouse

NEW_VS_PREVIOUS_DISTRICT = "Neno"  # FIXED VALUE: district label of the MOH report


def three_hp() -> Column:
    """3HP: isoniazid with rifapentine, or the combined tablet (first TPT visit)."""
    return ((F.col("first_inh_300").isNotNull() & F.col("first_rfp_150").isNotNull())
            | F.col("first_rfp_inh").isNotNull())


def six_h() -> Column:
    """6H: isoniazid without rifapentine (first TPT visit)."""
    return F.col("first_inh_300").isNotNull() & F.col("first_rfp_150").isNull()


def started_new(since: _dt.date) -> Column:
    s = lit_date(since)
    return (((F.col("initial_visit_date") >= s) & F.col("transfer_in_date").isNull())
            | (F.col("start_date") >= s))


def tpt_initiation_indicators(p: ReportParams) -> dict[str, Column]:
    s = lit_date(p.start)
    old = F.col("initial_visit_date") < s
    prev = F.col("previous_ipt_date")
    return {
        "new_start_three_hp": started_new(p.start) & three_hp(),
        "previous_start_three_hp": old & (prev < F.add_months(s, -1)) & three_hp(),
        "new_start_six_h": started_new(p.start) & six_h(),
        "previous_start_six_h": old & (prev < F.add_months(s, -2)) & six_h(),
    }


def tpt_initiation(wh: Warehouse, start: _dt.date, end: _dt.date, location: str | None = None) -> DataFrame:
    p = ReportParams(start=start, end=end, location=location)
    # the detail rows count patients who started in the period, the group rows all
    started = (f"if(coalesce(first_inh_300, first_rfp_150, first_rfp_inh) is not null and first_ipt_date >= {date_text(p.start)}, 1, 0)")
    out = order_report(report_counts(
        hiv_cohort(wh, p), facilities(wh, p.location), age_band("age", "gender"), "gender",
        {group_label("gender", "pregnant_or_lactating"): "1"}, tpt_initiation_indicators(p), age_labels(), detail=started))
    return out.select("location", F.lit(NEW_VS_PREVIOUS_DISTRICT).alias("district"), *[
        c for c in out.columns if c != "location"])


def pill_totals(wh: Warehouse, end: _dt.date, seven_start: _dt.date, thirteen_start: _dt.date) -> DataFrame:
    """Pills dispensed per patient over 13 months (isoniazid) and 7 months
    (rifapentine, combined) in ONE partial aggregate; null when no visit."""
    e = lit_date(end)
    vd = F.col("visit_date")
    in13 = vd.between(lit_date(thirteen_start), e)
    in7 = vd.between(lit_date(seven_start), e)
    fu = wh.mw_art_followup.where(vd.between(lit_date(min(seven_start, thirteen_start)), e))
    return fu.groupBy("patient_id").agg(
        F.sum(F.when(in13, F.col("inh_300_pills"))).alias("total_1_yr_inh_300_pills"),
        F.sum(F.when(in7, F.col("rfp_150_pills"))).alias("total_6_months_rfp_150_pills"),
        F.sum(F.when(in7, F.col("rfp_inh_pills"))).alias("total_6_months_rfp_inh_pills"),
    )


def tb_prev_indicators(six_start: _dt.date) -> dict[str, Column]:
    s = lit_date(six_start)
    new = started_new(six_start)
    old = F.col("initial_visit_date") < s
    hp_done = (F.coalesce(F.col("total_6_months_rfp_150_pills"), F.lit(0))
               + F.coalesce(F.col("total_6_months_rfp_inh_pills"), F.lit(0))) >= K.TPT_3HP_PILLS
    h_done = F.col("total_1_yr_inh_300_pills") >= K.TPT_6H_PILLS
    return {
        "new_start_three_hp": new & three_hp(),
        "new_start_six_h": new & six_h(),
        "previous_start_three_hp": old & three_hp(),
        "previous_start_six_h": old & six_h(),
        "completed_new_start_three_hp": new & hp_done,
        "completed_new_start_six_h": new & h_done,
        "completed_old_three_hp": old & hp_done,
        "completed_old_six_h": old & h_done,
    }


def tb_prev(wh: Warehouse, end: _dt.date, location: str | None = None) -> DataFrame:
    """TB_PREV: starts in the six-month period and completions (pill totals)."""
    six = period_start(end, months=6)
    seven = period_start(end, months=7)
    thirteen = period_start(end, months=13)
    quarter = period_start(end, days=90)
    p6 = ReportParams(start=six, end=end, location=location)
    # the procedure's distinct rows carry no blood pressure
    own = [c for c in COHORT_COLUMNS if c not in ("systolic_bp", "diastolic_bp")]
    rows = (hiv_cohort(wh, p6).select(*own).distinct()
            .join(pill_totals(wh, end, seven, thirteen), "patient_id", "left")
            .where(F.col("first_ipt_date") >= lit_date(six)))
    # group rows: the same rows once for each quarter cohort row of the patient,
    # grouped by that cohort row's sex and pregnancy status
    weights = hiv_cohort(wh, ReportParams(start=quarter, end=end, location=location)).groupBy("patient_id", "location").agg(
        *group_weights("gender", "pregnant_or_lactating"))
    return order_report(report_counts(
        rows.join(weights, ["patient_id", "location"], "left"), facilities(wh, location), age_band("age", "gender"), "gender",
        WEIGHTED, tb_prev_indicators(six), age_labels()))
