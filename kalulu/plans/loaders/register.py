"""Enrolment registers: programme-state intervals with outcome, number and last visit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.text import format_identifier
from kalulu.operators.concat import joined_texts
from kalulu.operators.latest import latest_per_key
from kalulu.plans.loaders import concepts as C
from kalulu.plans.loaders.art import load_art_visits
from kalulu.plans.loaders.lab import load_lab_tests_vl
from kalulu.plans.loaders.wide import load_eid_visits
from kalulu.sources.fixtures import Warehouse


def next_state_for_enrollment(ps: DataFrame, states: DataFrame) -> DataFrame:
    """The state of the same enrolment that starts on the day this one ends
    (another state; the lowest id when several do): an equi-join on
    (enrolment, date) and a partial aggregate -- no per-enrolment window."""
    cand = ps.select("program_enrollment_id", F.col("start_date").alias("end_date"),
                     F.col("program_state_id").alias("next_id"), F.col("state").alias("next_state"))
    pairs = (states.select("program_state_id", "program_enrollment_id", "end_date")
             .join(cand, ["program_enrollment_id", "end_date"])
             .where(F.col("next_id") != F.col("program_state_id")))
    return latest_per_key(pairs, ["program_state_id"], ["next_id"], ["next_state"], newest=False).select(
        "program_state_id", "next_state")


def state_intervals(wh: Warehouse, state: str) -> DataFrame:
    """Intervals of one treatment-status state, inner-joined to the enrolment:
    end = the state's end, else the enrolment's completion; outcome = the next
    state of the same enrolment, else the enrolment outcome."""
    ps = wh.omrs_program_state.where((F.col("program") == K.HIV_PROGRAM) & (F.col("workflow") == K.TREATMENT_WORKFLOW))
    states = ps.where((F.col("state") == state))
    states = states.join(next_state_for_enrollment(ps, states), "program_state_id", "left")
    enr = wh.omrs_program_enrollment.select("program_enrollment_id", "completion_date",
                                            F.col("outcome").alias("enrollment_outcome"))
    return states.join(enr, "program_enrollment_id", "inner").select(
        "program_state_id", "program_enrollment_id", "patient_id", "location", "start_date",
        F.coalesce("end_date", "completion_date").alias("end_date"),
        F.coalesce("next_state", "enrollment_outcome").alias("outcome"))


def newest_number(wh: Warehouse, id_type: str, out_col: str) -> DataFrame:
    """Newest identifier of a type per (patient, facility), formatted."""
    ids = wh.omrs_patient_identifier.where((F.col("type") == id_type)).select(
        "patient_id", "location", "date_created", "patient_identifier_id", "identifier")
    return latest_per_key(ids, ["patient_id", "location"], ["date_created", "patient_identifier_id"],
                          ["identifier"]).select("patient_id", "location",
                                                 format_identifier("identifier").alias(out_col))


def load_art_register(wh: Warehouse) -> DataFrame:
    """mw_art_register: 'On antiretrovirals' intervals + ARV Number + the patient's
    newest loaded ART visit and newest viral-load test / result (any facility)."""
    visits = load_art_visits(wh).select("patient_id", "visit_date", "art_visit_id")
    last_visit = latest_per_key(visits, ["patient_id"], ["visit_date", "art_visit_id"], []).select(
        "patient_id", F.col("art_visit_id").alias("last_art_visit_id"))
    tested = F.coalesce("date_collected", "date_result_received", "date_result_entered")
    lab = load_lab_tests_vl(wh).withColumn("tested", tested)

    def newest(tests: DataFrame, name: str) -> DataFrame:     # undated tests rank last, not out
        return latest_per_key(tests.select("patient_id", "tested", "lab_test_id"), ["patient_id"],
                              ["tested", "lab_test_id"], []).select("patient_id", F.col("lab_test_id").alias(name))
    with_result = lab.where(F.coalesce(F.col("result_numeric").cast("string"), F.col("result_coded"),
                                       F.col("result_exception")).isNotNull())
    return (state_intervals(wh, K.ON_ART)
            .join(newest_number(wh, K.ARV_NUMBER, "art_number"), ["patient_id", "location"], "left")
            .join(last_visit, "patient_id", "left")
            .join(newest(lab, "last_viral_load_test_id"), "patient_id", "left")
            .join(newest(with_result, "last_viral_load_result_id"), "patient_id", "left")
            .select(F.col("program_enrollment_id").alias("enrollment_id"), "patient_id", "location", "art_number", "start_date", "end_date", "outcome",
                    "last_art_visit_id", "last_viral_load_test_id", "last_viral_load_result_id"))


def load_pre_art_register(wh: Warehouse) -> DataFrame:
    """mw_pre_art_register: 'Pre-ART (Continue)' intervals + newest HCC Number."""
    return (state_intervals(wh, K.PRE_ART_CONTINUE)
            .join(newest_number(wh, K.HCC_NUMBER, "pre_art_number"), ["patient_id", "location"], "left")
            .select(F.col("program_enrollment_id").alias("enrollment_id"), "patient_id", "location", "pre_art_number", "start_date", "end_date", "outcome"))


def mother_art_numbers(wh: Warehouse) -> DataFrame:
    """All mother ART registration numbers recorded for a child, joined with ','
    (sorted, so the text is deterministic), cut as the source cuts them."""
    enc = wh.omrs_encounter.select("encounter_id", "patient_id")
    obs = wh.omrs_obs.where(F.col("concept") == C.MOTHER_ART_NUMBER).join(enc, "encounter_id")
    return joined_texts(obs, ["patient_id"], "value_text", "mother_art_number")


def load_eid_register(wh: Warehouse) -> DataFrame:
    """mw_eid_register: 'Exposed Child (Continue)' intervals + newest HCC Number +
    last EID visit + concatenated mother ART numbers."""
    visits = load_eid_visits(wh).select("patient_id", "visit_date", "eid_visit_id")
    last_visit = latest_per_key(visits, ["patient_id"], ["visit_date", "eid_visit_id"], []).select(
        "patient_id", F.col("eid_visit_id").alias("last_eid_visit_id"))
    return (state_intervals(wh, K.EXPOSED_CHILD_CONTINUE)
            .join(newest_number(wh, K.HCC_NUMBER, "eid_number"), ["patient_id", "location"], "left")
            .join(last_visit, "patient_id", "left")
            .join(mother_art_numbers(wh), "patient_id", "left")
            .select(F.col("program_enrollment_id").alias("enrollment_id"), "patient_id", "location", "eid_number", "start_date", "end_date", "outcome",
                    "last_eid_visit_id", "mother_art_number"))


def load_patient(wh: Warehouse) -> DataFrame:
    """mw_patient: demographics + the preferred community health worker
    (open-ended relationship first, then one with a start date, then newest)."""
    rel = wh.omrs_relationship.where(F.col("related_person_role") == "Community Health Worker").select(
        "patient_id", "related_person",
        F.col("end_date").isNull().cast("int").alias("open_ended"),
        F.col("start_date").isNotNull().cast("int").alias("has_start"), "date_created", "relationship_id")
    chw = latest_per_key(rel, ["patient_id"], ["open_ended", "has_start", "date_created", "relationship_id"],
                         ["related_person"]).select("patient_id", F.col("related_person").alias("chw"))
    pat = wh.omrs_patient.select(
        "patient_id", "identifier", "gender", "birthdate", "birthdate_estimated",
        F.col("state_province").alias("district"), F.col("county_district").alias("traditional_authority"),
        F.col("city_village").alias("village"), "dead", "death_date", "patient_uuid")
    return pat.join(chw, "patient_id", "left")
