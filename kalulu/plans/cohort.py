"""Facility cohort "as of" a reporting date.

``last_outcome_at_facility`` and ``hiv_cohort`` are computed for every
facility in one job (``location`` is a key column); a report for one facility
is the same plan with a pushed-down location filter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.dates import age_in_units, lit_date
from kalulu.operators.latest import latest_per_key, rows_at_extreme, tag_extremes
from kalulu.params import ReportParams
from kalulu.sources.fixtures import Warehouse

def facilities(wh: Warehouse, location: str | None = None) -> DataFrame:
    """The facility rows a report covers: (location, location_key)."""
    ll = wh.lookup_location.select(F.col("target_value").alias("location"),
                                   F.col("source_key").alias("location_key"))
    return ll.where(F.col("location") == location) if location else ll


def arv_numbers(wh: Warehouse) -> DataFrame:
    """ARV Numbers (type compared case-insensitively)."""
    return (wh.omrs_patient_identifier.where((F.col("type") == K.ARV_NUMBER))
            .select("patient_id", "identifier", "location"))


def last_outcome_at_facility(wh: Warehouse, end: _dt.date, location: str | None = None,
                             strict: bool = False, dedupe: bool = False) -> DataFrame:
    """Newest HIV-programme state per (patient, facility) with start <= end
    (``strict``: start < end), ties broken by the higher state id; joined to
    every ARV Number of the patient at that facility (fan-out kept) and to the
    facility key.  ``dedupe=True`` keeps one ARV Number per (patient, facility)
    (the smallest), so a patient with several numbers counts once.

    Columns: patient_id, identifier, state, program, program_state_id,
    start_date, end_date, location, location_key.
    """
    ps = wh.omrs_program_state.where((F.col("program") == K.HIV_PROGRAM))
    ps = ps.where(F.col("start_date") < lit_date(end) if strict else F.col("start_date") <= lit_date(end))
    if location:
        ps = ps.where(F.col("location") == location)
    latest = latest_per_key(ps.select("patient_id", "location", "start_date", "program_state_id",
                                      "state", "program", "end_date"),
                            keys=["patient_id", "location"], order=["start_date", "program_state_id"])
    out = (latest.join(arv_numbers(wh), ["patient_id", "location"], "inner")
           .join(facilities(wh, location), "location", "inner")
           .select("patient_id", "identifier", "state", "program", "program_state_id",
                   "start_date", "end_date", "location", "location_key"))
    if dedupe:
        cols = [c for c in out.columns if c not in ("patient_id", "location", "identifier")]
        out = latest_per_key(out, ["patient_id", "location"], ["identifier"], cols, newest=False).select(
            *out.columns)
    return out


TPT_COLS = ["inh_300", "inh_300_pills", "rfp_150", "rfp_150_pills", "rfp_inh", "rfp_inh_pills"]


def _tpt_any() -> Column:
    """Any preventive-therapy drug or pill count recorded on the visit."""
    return F.expr(" or ".join(f"{c} is not null" for c in TPT_COLS))

COHORT_COLUMNS = [
    "patient_id", "identifier", "state", "start_date", "gender", "age", "location",
    "last_appt_date", "current_regimen", "pregnant_or_lactating",
    "initial_pregnant_or_lactating", "initial_visit_date", "transfer_in_date",
    "first_ipt_date", *[f"first_{c}" for c in TPT_COLS],
    "last_ipt_date", *[f"last_{c}" for c in TPT_COLS],
    "previous_ipt_date", *[f"previous_{c}" for c in TPT_COLS],
    "systolic_bp", "diastolic_bp", "followup_visit_date",
]


def followup_snapshots(wh: Warehouse, p: ReportParams) -> DataFrame:
    """The four follow-up snapshots of the cohort, one row per patient: latest
    visit <= end, last / first TPT visit in [start, end], last TPT visit before
    start.  Each is an array of the rows on its date (ties are kept; also the
    non-TPT rows of a TPT date, as a join back to the date keeps them).

    Visits after ``end`` are filtered at the scan.  The dates are one partial
    aggregate; joined back, the rows of those dates are packed by patient in
    the same partitioning.
    """
    start, end = lit_date(p.start), lit_date(p.end)
    vd = F.col("visit_date")
    tpt = _tpt_any()
    fu = wh.mw_art_followup.where(vd <= end).select(
        "patient_id", "visit_date", "next_appointment_date", "art_regimen", "pregnant_or_lactating", "tb_status",
        "systolic_bp", "diastolic_bp", *TPT_COLS)
    tagged = tag_extremes(fu, "patient_id", "visit_date", {
        "__latest": ("max", vd <= end),
        "__last": ("max", vd.between(start, end) & tpt),
        "__previous": ("max", (vd <= F.date_sub(start, 1)) & tpt),
        "__first": ("min", vd.between(start, end) & tpt),
    })
    rows = {"latest": "visit_date as followup_visit_date, next_appointment_date as last_appt_date, art_regimen as current_regimen, "
                      "pregnant_or_lactating, tb_status, systolic_bp, diastolic_bp"}
    for prefix in ("last", "previous", "first"):
        rows[prefix] = ", ".join([f"visit_date as {prefix}_ipt_date", *[f"{c} as {prefix}_{c}" for c in TPT_COLS]])
    packed = [F.expr(f"collect_list(if(visit_date = __{name}, struct({fields}), null)) as {name}") for name, fields in rows.items()]
    on_a_date = " or ".join(f"visit_date = __{name}" for name in rows)
    return tagged.where(on_a_date).groupBy("patient_id").agg(*packed)


def latest_initial(wh: Warehouse, end: _dt.date) -> DataFrame:
    """Initial visits at the patient's latest initial-visit date <= end (ties kept)."""
    ini = wh.mw_art_initial.where(F.col("visit_date") <= lit_date(end))
    return rows_at_extreme(ini.select("patient_id", "visit_date", "pregnant_or_lactating", "transfer_in_date"),
                           ["patient_id"], "visit_date").select(
        "patient_id", F.col("visit_date").alias("initial_visit_date"),
        F.col("pregnant_or_lactating").alias("initial_pregnant_or_lactating"), "transfer_in_date")


def cohort_rows(wh: Warehouse, p: ReportParams, outcome: DataFrame | None = None,
                tpt: bool = True) -> DataFrame:
    """Undeduplicated cohort rows: ARV Number x last outcome at the facility x
    patient, left-joined to the follow-up snapshots and the latest initial
    visit.  ``tpt=False`` skips the three TPT snapshots (callers that project
    no TPT column get the same distinct rows without those joins)."""
    ops = outcome if outcome is not None else last_outcome_at_facility(wh, p.end, p.location)
    ops = ops.select("patient_id", "state", "start_date", "location", "program",
                     "program_state_id").distinct()
    base = (arv_numbers(wh).join(ops, ["patient_id", "location"], "inner")
            .join(wh.mw_patient.select("patient_id", "gender", "birthdate"), "patient_id", "inner"))
    snaps = followup_snapshots(wh, p)
    out = base.join(snaps if tpt else snaps.select("patient_id", "latest"), "patient_id", "left")
    for name in ("latest", "last", "previous", "first") if tpt else ("latest",):
        out = out.selectExpr("*", f"inline_outer({name})").drop(name)
    out = out.join(latest_initial(wh, p.end), "patient_id", "left")
    end = lit_date(p.end)
    age = F.when((F.col("state") == K.ON_ART), age_in_units(end, F.col("birthdate"), p.divider)).otherwise(
        age_in_units(F.col("start_date"), F.col("birthdate"), p.divider))
    return out.withColumn("age", age)


def hiv_cohort(wh: Warehouse, p: ReportParams, outcome: DataFrame | None = None,
               extra: tuple[str, ...] = ()) -> DataFrame:
    """Patients with an ARV Number and a last outcome at the facility, with
    their latest follow-up, TPT visits and latest initial visit (distinct rows).

    ``extra`` names more follow-up columns of the distinct rows (``tb_status``).
    The result is lazy; a caller that reads it several times may checkpoint it.
    """
    return cohort_rows(wh, p, outcome).selectExpr(*COHORT_COLUMNS, *extra).distinct()


def identifier_flags(wh: Warehouse, location: str | None = None) -> DataFrame:
    """Per (patient, facility): has an ARV Number here / anywhere else.

    One partial aggregate over the identifiers (existence flags instead of
    IN / NOT IN subqueries).  ``elsewhere`` = number of facilities with a
    number; combined with ``here`` it answers "here and nowhere else".
    """
    ids = arv_numbers(wh)
    per_patient = ids.groupBy("patient_id").agg(F.countDistinct("location").alias("n_locations"))
    here = ids.select("patient_id", "location").distinct()
    if location:
        here = here.where(F.col("location") == location)
    return (here.join(per_patient, "patient_id")
            .select("patient_id", "location", F.lit(True).alias("number_here"),
                    (F.col("n_locations") == 1).alias("only_here")))
