"""Yearly survival analysis: 21 yearly registration cohorts in one job.

For i = 0..20 the period is [start - i years, end - i years]; the last
outcome, the latest follow-up and the registrations are computed per period
key from one pass over each table (see ``operators.periods``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.operators.counts import count_if
from kalulu.operators.periods import latest_as_of_periods, period_in_range, rows_at_max_per_period
from kalulu.params import _add_months
from kalulu.plans.cohort import arv_numbers, facilities
from kalulu.sources.fixtures import Warehouse

YEARS = 21


def survival(wh: Warehouse, start: _dt.date, end: _dt.date, location: str | None = None,
             age_limit_years: int = 200, subgroup: str = "General", option_b: bool = False,
             cutoff: int = K.MOH_CUTOFF_DAYS, as_of: _dt.date | None = None) -> DataFrame:
    starts = [_add_months(start, -12 * i) for i in range(YEARS)]
    ends = [_add_months(end, -12 * i) for i in range(YEARS)]
    as_of = as_of or end
    periods = wh.spark.createDataFrame(
        [(i, starts[i], ends[i]) for i in range(YEARS)], "period int, p_start date, p_end date")

    # patients registered in the period, joined to ALL their initial visits
    ini = wh.mw_art_initial.select("patient_id", "visit_date", "transfer_in_date", "pregnant_or_lactating")
    registered = (ini.withColumn("period", period_in_range("visit_date", starts, ends))
                  .where(F.col("period").isNotNull()).select("patient_id", "period").distinct())
    visits = registered.join(ini.withColumnRenamed("visit_date", "art_initial_visit"), "patient_id")
    # last outcome per registered (patient, period) and facility, x ARV Numbers there
    ps = wh.omrs_program_state.where((F.col("program") == K.HIV_PROGRAM))
    ps = ps.join(registered.select("patient_id").distinct(), "patient_id", "left_semi")
    if location:
        ps = ps.where(F.col("location") == location)
    lfo = latest_as_of_periods(ps, ["patient_id", "location"], "start_date", ends,
                               order=["start_date", "program_state_id"], payload=["state"])
    lfo = (lfo.join(registered, ["patient_id", "period"], "left_semi")
           .join(arv_numbers(wh), ["patient_id", "location"]).join(facilities(wh, location), "location"))
    # latest follow-up (ties kept) per period, of registered patients only
    seen = wh.mw_art_followup.select("patient_id", "visit_date", "next_appointment_date").join(
        registered.select("patient_id").distinct(), "patient_id", "left_semi")
    fu = rows_at_max_per_period(seen, "patient_id", "visit_date", ends).select(
        "patient_id", "period", F.col("next_appointment_date").alias("last_appt_date"))
    pat = wh.mw_patient.select("patient_id", "birthdate")
    rows = (lfo.join(pat, "patient_id").join(fu, ["patient_id", "period"])
            .join(visits, ["patient_id", "period"]).join(F.broadcast(periods), "period")
            .where((F.floor(F.datediff(F.col("p_end"), F.col("birthdate")) / 365) <= age_limit_years)
                   & F.col("transfer_in_date").isNull()))
    if option_b:
        one_number = (arv_numbers(wh).groupBy("patient_id").count().where(F.col("count") == 1)
                      .select("patient_id"))
        rows = (rows.where(F.col("pregnant_or_lactating").isin([K.BREASTFEEDING, K.PREGNANT]))
                .join(one_number, "patient_id", "left_semi"))
    in_p = F.col("start_date").between(F.col("p_start"), F.col("p_end"))
    late = F.floor(F.datediff(F.col("p_end"), F.col("last_appt_date"))) > cutoff
    on_art = (F.col("state") == K.ON_ART)
    counts = rows.groupBy("location", "period").agg(
        count_if(F.col("art_initial_visit").between(F.col("p_start"), F.col("p_end"))).alias("new_reg"),
        count_if(on_art & (F.datediff(F.col("p_end"), F.col("last_appt_date")) <= cutoff)).alias("active"),
        count_if((F.col("state") == K.DIED) & in_p).alias("died"),
        count_if(((F.col("state") == K.DEFAULTED) & in_p) | (on_art & late)
                 | (on_art & F.col("last_appt_date").isNull())).alias("defaulted"),
        count_if((F.col("state") == K.STOPPED) & in_p).alias("treatment_stopped"),
        count_if((F.col("state") == K.TRANSFERRED_OUT) & in_p).alias("transferred_out"))
    # every (facility, period) gets a row (the zero seed row of each yearly run)
    grid = facilities(wh, location).select("location", F.explode(F.sequence(F.lit(0), F.lit(YEARS - 1)))
                                           .alias("period"))
    first_year = (wh.mw_art_initial.groupBy("location").agg(F.year(F.min("visit_date")).alias("first_year")))
    z = F.lit(0).cast("bigint")
    out = (grid.join(counts, ["location", "period"], "left").join(F.broadcast(periods), "period")
           .join(first_year, "location", "left")
           .withColumn("reporting_year", F.year("p_end"))
           .where(F.col("first_year").isNull() | (F.col("reporting_year") > F.col("first_year"))))
    c = {n: F.coalesce(F.col(n), z) for n in ("active", "died", "defaulted", "treatment_stopped",
                                               "transferred_out")}
    return out.select(
        "location", "reporting_year", F.quarter("p_end").alias("reporting_quarter"),
        F.concat(F.lit("Q"), F.lit(str((end.month - 1) // 3 + 1)), F.lit(" "),
                 F.col("reporting_year").cast("string")).alias("reg_cohort"),
        ((F.lit(as_of.year) - F.col("reporting_year")) * 12).alias("interval_year"),
        F.lit(subgroup).alias("subgroup"),
        (c["active"] + c["died"] + c["defaulted"] + c["treatment_stopped"] + c["transferred_out"])
        .alias("total_reg_database"),
        c["active"].alias("alive"), c["died"].alias("died"), c["defaulted"].alias("defaulted"),
        c["treatment_stopped"].alias("stopped"), c["transferred_out"].alias("to"),
        F.lit(0).alias("unknown")).orderBy("location", "reporting_year")
