"""Viral-load suppression (TX_PVLS) and the regimen-dispensation reports."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.dates import age_in_units, lit_date
from kalulu.functions.text import regimen_code, regimen_name, sex_label
from kalulu.functions.sqltext import quoted
from kalulu.operators.bands import age_band, age_labels, weight_band, weight_labels
from kalulu.operators.counts import WEIGHTED, banded_counts, group_weights, report_counts
from kalulu.operators.latest import latest_per_key, rows_at_extreme
from kalulu.params import ReportParams, period_start
from kalulu.plans.cohort import arv_numbers, facilities, hiv_cohort, last_outcome_at_facility
from kalulu.plans.reports.common import latest_followup, order_report
from kalulu.sources.fixtures import Warehouse


def vl_result_text() -> Column:
    """'LDL' when flagged, else the reason for no result, else the number, else '<limit'."""
    return (F.when(F.col("ldl").isNotNull(), F.lit("LDL"))
            .when(F.col("other_results").isNotNull(), F.col("other_results"))
            .when(F.col("viral_load_result").isNotNull(), F.col("viral_load_result").cast("string"))
            .when(F.col("less_than_limit").isNotNull(), F.col("less_than_limit").cast("string")))


def pvls_indicators() -> dict[str, Column]:
    ltl, vl = F.col("less_than_limit"), F.col("viral_load_result")
    low = (ltl < K.VL_SUPPRESSED_BELOW) | (vl < K.VL_SUPPRESSED_BELOW) | (F.col("ldl") == K.LDL_TRUE)
    high = (ltl > K.VL_SUPPRESSED_BELOW) | (vl > K.VL_SUPPRESSED_BELOW)
    routine, target = (F.col("reason_for_test") == K.ROUTINE), (F.col("reason_for_test") == K.TARGET)
    return {
        "tx_curr": (F.col("state") == K.ON_ART),
        "due_for_vl": F.datediff("next_appointment_date", "test_date") > K.VL_TEST_AGE_DAYS,
        "routine_samples_drawn": routine,
        "target_samples_drawn": target,
        "routine_low_vl_less_than_1000_copies": low & routine,
        "routine_high_vl_more_than_1000_copies": high & routine,
        "targeted_low_vl_less_than_1000_copies": low & target,
        "targeted_high_vl_more_than_1000_copies": high & target,
    }


def pvls_rows(wh: Warehouse, end: _dt.date, year_start: _dt.date, outcome: DataFrame) -> DataFrame:
    """Latest VL and latest follow-up as of the year start; appointment in the
    year and more than 365 days after the test; every ARV Number of the
    patient (any facility) and every outcome row at the test's facility."""
    ys = lit_date(year_start)
    vl = rows_at_extreme(wh.mw_art_viral_load.where(F.col("visit_date") <= ys), ["patient_id"], "visit_date")
    vl = vl.withColumnRenamed("visit_date", "test_date").where(F.col("reason_for_test").isin([K.ROUTINE, K.TARGET]))
    fu = rows_at_extreme(wh.mw_art_followup.where(F.col("visit_date") <= ys).select(
        "patient_id", "visit_date", "next_appointment_date"), ["patient_id"], "visit_date")
    fu = fu.select("patient_id", F.col("visit_date").alias("last_visit_date"), "next_appointment_date")
    pat = wh.mw_patient.select("patient_id", "gender", "birthdate")
    ids = arv_numbers(wh).select("patient_id", "identifier")
    lfo = outcome.select("patient_id", "location", "state")
    rows = (vl.join(fu, "patient_id").join(pat, "patient_id").join(ids, "patient_id")
            .join(lfo, ["patient_id", "location"], "left")
            .where(F.col("next_appointment_date").between(ys, lit_date(end))
                   & (F.datediff("next_appointment_date", "test_date") > K.VL_TEST_AGE_DAYS)))
    return rows.withColumn("age", age_in_units(lit_date(end), F.col("birthdate"), K.BIRTHDATE_DIVIDER))


def tx_pvls(wh: Warehouse, end: _dt.date, location: str | None = None) -> DataFrame:
    year_start = period_start(end, months=12)
    outcome = last_outcome_at_facility(wh, end, location)
    rows = pvls_rows(wh, end, year_start, outcome)
    if location:
        rows = rows.where(F.col("location") == location)
    weights = hiv_cohort(wh, ReportParams(start=year_start, end=end, location=location)).groupBy("patient_id", "location").agg(
        *group_weights("gender", "pregnant_or_lactating"))
    return order_report(report_counts(
        rows.join(weights, ["patient_id", "location"], "left"), facilities(wh, location), age_band("age", "gender"), "gender",
        WEIGHTED, pvls_indicators(), age_labels()))


def _dispensed(wh: Warehouse, end: _dt.date, location: str | None, cutoff: int) -> DataFrame:
    """Latest follow-up rows (<= end) of patients on ART at the facility, appointment
    at most ``cutoff`` days before end, with each ARV Number at that facility and
    a weight (the visit's, else the patient's newest recorded weight)."""
    p = ReportParams(start=end, end=end, location=location, cutoff=cutoff)
    outcome = last_outcome_at_facility(wh, end, location)
    on_art = outcome.where((F.col("state") == K.ON_ART)).select("patient_id", "location").distinct()
    fu = latest_followup(wh, p).where(F.datediff(lit_date(end), F.col("next_appointment_date")) <= cutoff)
    fu = fu.drop("location")
    ids = arv_numbers(wh)
    if location:
        ids = ids.where(F.col("location") == location)
    newest_weight = latest_per_key(
        wh.mw_art_followup.where(F.col("weight").isNotNull()).select("patient_id", "visit_date", "weight"),
        keys=["patient_id"], order=["visit_date", "weight"]).select(
        "patient_id", F.col("weight").alias("fallback_weight"))
    pat = wh.mw_patient.select("patient_id", "gender", "birthdate")
    return (fu.join(on_art, "patient_id").join(ids, ["patient_id", "location"]).join(pat, "patient_id")
            .join(newest_weight, "patient_id", "left")
            .withColumn("weight", F.coalesce(F.col("weight"), F.col("fallback_weight"))))


def regimen_dispensation(wh: Warehouse, end: _dt.date, location: str | None = None,
                         cutoff: int = K.MOH_CUTOFF_DAYS) -> DataFrame:
    """Patient list: one row per dispensing visit x ARV Number x initial visit."""
    rows = _dispensed(wh, end, location, cutoff)
    mai = wh.mw_art_initial.select("patient_id", F.col("visit_date").alias("art_start_date"))
    vl = rows_at_extreme(wh.mw_art_viral_load.where(F.col("visit_date") <= lit_date(end)).select(
        "patient_id", "visit_date", "viral_load_result", "less_than_limit", "ldl", "other_results"),
        ["patient_id"], "visit_date").withColumnRenamed("visit_date", "date_of_vl_result")
    out = rows.join(mai, "patient_id").join(vl, "patient_id", "left")
    return out.select(
        "identifier", sex_label("gender").alias("gender"), F.col("birthdate").alias("dob"), "art_start_date",
        "weight", regimen_code("art_regimen").alias("art_regimen"),
        F.concat(regimen_name("art_regimen"), F.lit("("), F.col("arvs_given").cast("string"), F.lit(")"))
        .alias("arvs_given"),
        F.col("visit_date").alias("dispense_date"), "location", vl_result_text().alias("vl_result"),
        "date_of_vl_result")


def regimen_by_weight(wh: Warehouse, end: _dt.date, location: str | None = None,
                      cutoff: int = K.MOH_CUTOFF_DAYS) -> DataFrame:
    """Counts per regimen by weight band x sex (24 rows per facility)."""
    rows = _dispensed(wh, end, location, cutoff).withColumn("current_regimen", F.col("art_regimen"))
    codes = list(K.REGIMENS) + [K.WEIGHT_REPORT_EXTRA_REGIMENS[0]]
    extra_11p = K.WEIGHT_REPORT_EXTRA_REGIMENS[1]
    ind = {code: F.expr(f"current_regimen = {quoted(text)}") for code, text in codes}
    ind_all = dict(ind)
    ind_all[extra_11p[0]] = F.col("current_regimen") == extra_11p[1]  # counted, not output
    out = banded_counts(rows, facilities(wh, location), weight_band("weight"), F.col("gender"), ind_all,
                        weight_labels(), band_col="weight_group")
    return order_report(out.drop(extra_11p[0]))
