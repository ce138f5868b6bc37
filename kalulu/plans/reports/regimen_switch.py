"""Regimen switches: patients whose regimen at the first visit of a month
differs from the regimen at their last visit before that month; three
consecutive months in one job."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.functions.dates import report_date_label
from kalulu.functions.text import differs, parent_facility, regimen_code, regimen_name, sex_label
from kalulu.operators.periods import max_as_of_periods, period_in_range
from kalulu.params import _add_months
from kalulu.plans.cohort import arv_numbers
from kalulu.sources.fixtures import Warehouse

MONTHS = 3


def regimen_switch(wh: Warehouse, start: _dt.date, location: str | None = None) -> DataFrame:
    month_starts = [_add_months(start, k) for k in range(MONTHS)]
    month_ends = [_add_months(m, 1) - _dt.timedelta(days=1) for m in month_starts]
    # period index p = MONTHS-1-k so that the "before" ends decrease with p
    before_ends = [month_starts[MONTHS - 1 - p] - _dt.timedelta(days=1) for p in range(MONTHS)]
    visits = wh.mw_art_visits.select("patient_id", "visit_date")
    fu = wh.mw_art_followup.select("patient_id", "visit_date", "art_regimen", "arvs_given", "location", "weight")
    last_before = max_as_of_periods(visits, "patient_id", "visit_date", before_ends)
    prev = fu.join(last_before, ["patient_id", "visit_date"]).select(
        "patient_id", "period", F.col("art_regimen").alias("previous_full"))
    first_in = (visits.withColumn("k", period_in_range("visit_date", month_starts, month_ends))
                .where(F.col("k").isNotNull()).groupBy("patient_id", "k").agg(F.min("visit_date").alias("visit_date"))
                .withColumn("period", F.lit(MONTHS - 1) - F.col("k")))
    cur = fu.join(first_in, ["patient_id", "visit_date"]).select(
        "patient_id", "period", F.col("visit_date").alias("last_visit_date"),
        F.col("art_regimen").alias("current_full"), "arvs_given", "location", "weight")
    ids = arv_numbers(wh).select("patient_id", "identifier", F.col("location").alias("report_location"))
    if location:
        ids = ids.where(F.col("report_location") == location)
    pat = wh.mw_patient.select("patient_id", "gender", "birthdate")
    # the number must be held at the parent facility of the visit location
    x = (prev.join(cur, ["patient_id", "period"])
         .where(differs("previous_full", "current_full"))
         .withColumn("report_location", parent_facility(F.col("location")))
         .join(ids, ["patient_id", "report_location"])
         .join(pat, "patient_id"))
    mai = wh.mw_art_initial.select("patient_id", F.col("visit_date").alias("initial_date"))
    out = mai.join(x, "patient_id")
    return out.select(
        "identifier", sex_label("gender").alias("gender"), report_date_label(F.col("birthdate")).alias("dob"),
        report_date_label(F.col("initial_date")).alias("art_start_date"),
        F.col("weight").cast("decimal(12,0)").alias("weight"),
        regimen_code("previous_full").alias("previous_regimen"),
        regimen_code("current_full").alias("current_regimen"),
        report_date_label(F.col("last_visit_date")).alias("dispense_date"),
        F.concat(regimen_name("current_full"), F.lit(" ("), F.col("arvs_given").cast("string"), F.lit(")"))
        .alias("arvs"),
        "arvs_given", "location", "report_location")
