"""Return to treatment (TX_RTT)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.dates import age_in_units, lit_date, months_between_completed
from kalulu.operators.bands import age_band, age_labels
from kalulu.operators.counts import banded_counts
from kalulu.operators.latest import rows_at_extreme
from kalulu.plans.cohort import arv_numbers, facilities, last_outcome_at_facility
from kalulu.plans.reports.common import order_report
from kalulu.sources.fixtures import Warehouse


def tx_rtt(wh: Warehouse, start: _dt.date, end: _dt.date, location: str | None = None,
           cutoff: int = K.PEPFAR_CUTOFF_DAYS) -> DataFrame:
    s, e = lit_date(start), lit_date(end)
    # last appointment before the period (from all ART visits)
    before_visits = (wh.mw_art_visits.where(F.col("visit_date") < s).groupBy("patient_id")
                     .agg(F.max("next_appointment_date").alias("last_appt_date"))
                     .withColumn("default_date", F.date_add("last_appt_date", K.RTT_APPT_GRACE_DAYS)))
    # state before the period (strict), x ARV Numbers there (fan-out kept)
    before = last_outcome_at_facility(wh, start, location, strict=True).select(
        "patient_id", "location", "state")
    base = arv_numbers(wh).join(before, ["patient_id", "location"])
    # back on ART at the end: state started in the period, appointment recent,
    # first follow-up visit in the period and the CD4 taken that day
    after = last_outcome_at_facility(wh, end, location).where(
        (F.col("state") == K.ON_ART) & F.col("start_date").between(s, e)).select("patient_id", "location")
    latest = rows_at_extreme(wh.mw_art_followup.where(F.col("visit_date") <= e).select(
        "patient_id", "visit_date", "next_appointment_date"), ["patient_id"], "visit_date").select(
        "patient_id", "next_appointment_date")
    first = rows_at_extreme(wh.mw_art_followup.where(F.col("visit_date").between(s, e)).select(
        "patient_id", "visit_date"), ["patient_id"], "visit_date", newest=False).select(
        "patient_id", F.col("visit_date").alias("first_visit_date"))
    cd4 = wh.mw_art_followup_testing.select(
        "patient_id", F.col("visit_date").alias("first_visit_date"), F.col("cd4_count").alias("cd4_count_at_restart"))
    visits = (after.join(latest, "patient_id").join(first, "patient_id", "left")
              .join(cd4, ["patient_id", "first_visit_date"], "left")
              .where(F.datediff(e, F.col("next_appointment_date")) < cutoff)
              .select("patient_id", "location", "first_visit_date", "cd4_count_at_restart"))
    pat = wh.mw_patient.select("patient_id", "gender", "birthdate")
    rows = (base.join(pat, "patient_id").join(before_visits, "patient_id", "left")
            .join(visits, ["patient_id", "location"], "left")
            .where((((F.col("state") == K.ON_ART)
                     & (F.datediff(F.date_sub(s, 1), F.col("last_appt_date")) > cutoff))
                    | F.col("state").isin([K.DEFAULTED, K.STOPPED]))
                   & F.col("first_visit_date").isNotNull())
            .withColumn("age", age_in_units(e, F.col("birthdate"), K.BIRTHDATE_DIVIDER))
            .withColumn("months_out_of_care", months_between_completed(F.col("default_date"),
                                                                       F.col("first_visit_date"))))
    m = F.col("months_out_of_care")
    cd4v = F.col("cd4_count_at_restart")
    any_bucket = (m < 3) | m.between(3, 5) | (m >= 6)
    ind = {
        "cd4_less_than_two_hundred": any_bucket & cd4v.isNotNull() & (cd4v < K.CD4_THRESHOLD),
        "cd4_equal_to_or_greater_than_two_hundred": m.between(3, 5) & cd4v.isNotNull() & (cd4v >= K.CD4_THRESHOLD),
        "cd4_unknown_or_not_done": any_bucket & cd4v.isNull(),
        "not_eligible_for_cd4": F.lit(False),
        "returned_less_than_three_months": m < 3,
        "returned_three_to_five_months": m.between(3, 5),
        "returned_six_months_plus": m >= 6,
    }
    return order_report(banded_counts(rows, facilities(wh, location), age_band("age", "gender"),
                                      F.col("gender"), ind, age_labels()))
