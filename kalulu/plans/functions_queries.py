"""Per-patient lookup functions of the source system, as set-based queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.functions.text import format_identifier, parent_facility
from kalulu.operators.latest import latest_per_key, nth_latest
from kalulu.sources.fixtures import Warehouse


def parent_facilities(wh: Warehouse) -> DataFrame:
    """Every follow-up visit location with its parent facility."""
    return (wh.mw_art_followup.select("location").distinct()
            .select("location", parent_facility(F.col("location")).alias("parent_facility")))


def formatted_identifiers(wh: Warehouse) -> DataFrame:
    """Every identifier in the register format (blank-split, digits padded to 4, '-')."""
    return wh.omrs_patient_identifier.select(
        "patient_identifier_id", "identifier", format_identifier("identifier").alias("formatted"))


def _tests(lab: DataFrame, test_type: str, date: str, date_from, date_to, with_result: bool) -> DataFrame:
    """Tests of a type, optionally bounded by a date (a bound is only a condition when given)."""
    t = lab.where(F.col("test_type") == test_type)
    if with_result:
        t = t.where(F.coalesce(F.col("result_numeric").cast("string"), F.col("result_coded"),
                               F.col("result_exception")).isNotNull())
    if date_from is not None:
        t = t.where(F.col(date) >= F.lit(date_from))
    if date_to is not None:
        t = t.where(F.col(date) <= F.lit(date_to))
    return t.select("patient_id", date, "lab_test_id")


def latest_test_result(lab: DataFrame, test_type: str, offset: int = 0, date_from=None, date_to=None) -> DataFrame:
    """Per patient: the test of a type with any result that is the (offset+1)-th
    newest by date entered (undated last)."""
    t = _tests(lab, test_type, "date_result_entered", date_from, date_to, True)
    return nth_latest(t, ["patient_id"], ["date_result_entered", "lab_test_id"], offset)


def first_test_result(lab: DataFrame, test_type: str, end=None) -> DataFrame:
    """Per patient: the first test of a type with any result by date entered
    (undated first, as nulls sort in the source), entered by ``end`` when given."""
    t = _tests(lab, test_type, "date_result_entered", None, end, True)
    return latest_per_key(t, ["patient_id"], ["date_result_entered", "lab_test_id"], [], newest=False)


def latest_test_by_sample_date(lab: DataFrame, test_type: str, offset: int = 0, date_from=None, date_to=None) -> DataFrame:
    """Per patient: the (offset+1)-th newest test of a type by sample date (no
    result needed; undated samples last)."""
    t = _tests(lab, test_type, "date_collected", date_from, date_to, False)
    return nth_latest(t, ["patient_id"], ["date_collected", "lab_test_id"], offset)


def regimen_at_offset(regimens: DataFrame, offset: int = 0) -> DataFrame:
    """get_regimen / get_regimen_start: the (offset+1)-th newest regimen line per
    patient by start date (undated lines last)."""
    return nth_latest(regimens.select("patient_id", "regimen_init_date", "num_of_prev_regimens", "regimen"),
                      ["patient_id"], ["regimen_init_date", "num_of_prev_regimens", "regimen"], offset).select(
        "patient_id", "regimen", F.col("regimen_init_date").alias("regimen_start"))


def first_date_no_breastfeeding(eid_visits: DataFrame, end, after_invalid: bool = False) -> DataFrame:
    """Per child: the earliest visit recorded as "stopped over 6 weeks ago".

    When the child also has a visit with another status on or before ``end``
    (the last such date is ``last_invalid``), the stopped visit must be on or
    before ``end`` and on or before ``last_invalid`` -- the source's condition,
    kept as written.  Two partial aggregates per child, no per-child loop.
    """
    from kalulu.plans.loaders import concepts as C

    e = F.lit(end).cast("date")
    status = F.col("breastfeeding_status")
    invalid = (eid_visits.where((status != C.BREASTFEEDING_STOPPED) & (F.col("visit_date") <= e))
               .groupBy("patient_id").agg(F.max("visit_date").alias("last_invalid")))
    stopped = eid_visits.where(status == C.BREASTFEEDING_STOPPED).select("patient_id", "visit_date")
    if after_invalid:
        cond = (F.col("visit_date") <= e) & (F.col("last_invalid").isNull()
                                             | (F.col("visit_date") > F.col("last_invalid")))
    else:
        cond = F.col("last_invalid").isNull() | ((F.col("visit_date") <= e)
                                                 & (F.col("visit_date") <= F.col("last_invalid")))
    cand = stopped.join(invalid, "patient_id", "left").where(cond)
    return cand.groupBy("patient_id").agg(F.min("visit_date").alias("first_date_no_breastfeeding"))
