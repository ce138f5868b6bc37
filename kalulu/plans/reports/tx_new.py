"""Newly initiated on ART (TX_NEW) by CD4 at initiation, plus transfer-ins."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.dates import age_in_units, lit_date
from kalulu.operators.bands import age_band, age_labels
from kalulu.operators.counts import WEIGHTED, group_weights, report_counts
from kalulu.operators.latest import rows_at_extreme
from kalulu.params import ReportParams
from kalulu.plans.cohort import (arv_numbers, facilities, hiv_cohort, identifier_flags,
                                 last_outcome_at_facility)
from kalulu.plans.reports.common import order_report
from kalulu.sources.fixtures import Warehouse


def tx_new_indicators(p: ReportParams, initial_date: str = "initial_visit_date",
                      transfer: str = "transfer_in_date", cd4: str = "cd4_count") -> dict[str, Column]:
    in_period = F.col(initial_date).between(lit_date(p.start), lit_date(p.end))
    here_only = F.coalesce(F.col("only_here"), F.lit(False))
    new_here = in_period & F.col(transfer).isNull() & here_only
    c = F.col(cd4)
    return {
        "tx_new_cd4_less_than_two_hundred": new_here & (c < K.CD4_THRESHOLD),
        "tx_new_cd4_equal_to_or_greater_than_two_hundred": new_here & (c >= K.CD4_THRESHOLD),
        "tx_new_cd4_equal_unknown_or_not_done": new_here & c.isNull(),
        "transfer_ins": F.col(transfer).isNotNull() & in_period & here_only,
    }


def tx_new_rows(wh: Warehouse, p: ReportParams, outcome: DataFrame) -> DataFrame:
    """Facility cohort x the latest initial visit (ties kept), distinct."""
    ini = wh.mw_art_initial.where(F.col("visit_date") <= lit_date(p.end)).select(
        "patient_id", "visit_date", "cd4_count", "transfer_in_date")
    ini = rows_at_extreme(ini, ["patient_id"], "visit_date").withColumnRenamed(
        "visit_date", "initial_visit_date")
    ops = outcome.select("patient_id", "location", "program", "state", "start_date", "program_state_id")
    pat = wh.mw_patient.select("patient_id", "gender", "birthdate")
    base = (arv_numbers(wh).join(ops, ["patient_id", "location"]).join(pat, "patient_id")
            .join(ini, "patient_id", "left"))
    age = F.when((F.col("state") == K.ON_ART), age_in_units(lit_date(p.end), F.col("birthdate"), p.divider)).otherwise(
        age_in_units(F.col("start_date"), F.col("birthdate"), p.divider))
    return base.withColumn("age", age).select(
        "patient_id", "identifier", "program", "state", "start_date", "program_state_id", "gender", "age",
        "location", "initial_visit_date", "transfer_in_date", "cd4_count").distinct()


def tx_new(wh: Warehouse, start: _dt.date, end: _dt.date, location: str | None = None,
           cutoff: int = K.MOH_CUTOFF_DAYS) -> DataFrame:
    p = ReportParams(start=start, end=end, location=location, cutoff=cutoff)
    outcome = last_outcome_at_facility(wh, p.end, p.location)
    flags = identifier_flags(wh, p.location)
    locs = facilities(wh, p.location)
    # group rows: every initial visit of the patient joined to the cohort rows;
    # the period test uses the cohort's latest initial visit, CD4 and
    # transfer-in come from each initial visit.  Both sides are counted first: the
    # visits by what the indicators tell apart, the cohort rows by group
    cohort = hiv_cohort(wh, p).groupBy("patient_id", "location", "initial_visit_date").agg(
        *group_weights("gender", "pregnant_or_lactating"))
    visits = wh.mw_art_initial.groupBy(
        "patient_id", F.expr(f"cd4_count >= {K.CD4_THRESHOLD}").alias("__high"), F.expr("transfer_in_date is null").alias("__own")).agg(
        F.min("cd4_count").alias("cd4_count"), F.min("transfer_in_date").alias("transfer_in_date"), F.count(F.lit(1)).alias("__visits"))
    grouped = visits.join(cohort, "patient_id").selectExpr(
        "patient_id", "location", "initial_visit_date", "transfer_in_date", "cd4_count", *[f"{w} * __visits as {w}" for w in WEIGHTED.values()])
    rows = tx_new_rows(wh, p, outcome).unionByName(grouped, allowMissingColumns=True).join(flags, ["patient_id", "location"], "left")
    # a row of the visits has no sex: it counts for no band
    return order_report(report_counts(rows, locs, age_band("age", "gender"), "gender", WEIGHTED, tx_new_indicators(p), age_labels()))
