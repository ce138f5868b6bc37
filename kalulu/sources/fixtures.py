"""Projection of the driver tables into the clinical source and warehouse schemas.

The driver ships TPC-H-like tables.  Every clinical table used by the reports
and loaders is derived from them by deterministic integer / day arithmetic
(k = o_orderkey, p = o_custkey or c_custkey, d = order date), so the work of
every report grows with the driver tables.  The same formulas are written a
second time, independently, as SQL in ``oracle/fixtures_sql.py``.

Everything here is lazy: a report only pays for the tables (and columns) it
reads, and Catalyst prunes every unused derived column.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from kalulu import constants as K
from kalulu.functions.sqltext import pick, quoted
from kalulu.sources.tables import read_parquet

# Fixed reference date of the projection (birthdates count back from it).
ANCHOR = "2000-06-30"

# FIXED VALUES (fixture only): the follow-up regimen cycles over every text the
# reports count, then the two weight-report extras.
REGIMEN_CYCLE = [t for _, t in K.REGIMENS] + [t for _, t in K.WEIGHT_REPORT_EXTRA_REGIMENS]
PREGNANCY_CYCLE = [K.PREGNANT, K.BREASTFEEDING, K.NOT_PREGNANT, None]
EXTRA_STATE_ID_OFFSET = 1_000_000_000
EXTRA_STATE_DAYS = 7300


def facility(index: str) -> str:
    return pick(K.FACILITIES, index)


FEMALE = "p % 2 = 0"


class Warehouse:
    """Clinical tables projected from one driver data directory, all lazy.

    Any object with the same attributes serves the plans; see
    ``kalulu.sources.warehouse`` for stored tables and for loaded ones.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    # -- driver tables -------------------------------------------------------
    @functools.cached_property
    def _orders(self) -> DataFrame:
        return read_parquet(self.spark, self.base, "orders").selectExpr("o_orderkey as k", "o_custkey as p", "cast(o_orderdate as date) as d")

    @functools.cached_property
    def _customers(self) -> DataFrame:
        return read_parquet(self.spark, self.base, "customer").selectExpr("c_custkey as p")

    # -- source tables ---------------------------------------------------------
    @functools.cached_property
    def mw_patient(self) -> DataFrame:
        return self._customers.selectExpr(
            "p as patient_id", "concat('NNO ', cast(p as string)) as identifier", f"if({FEMALE}, 'F', 'M') as gender",
            f"date_sub(date '{ANCHOR}', cast((p * 7919) % 33000 as int)) as birthdate",
            "false as birthdate_estimated", "false as dead", "cast(null as date) as death_date")

    @functools.cached_property
    def omrs_program_state(self) -> DataFrame:
        """Two states per order: a treatment status, and a pre-ART or exposed-child
        state dated 20 years later, i.e. after every report period.  A third of
        the statuses end on the day that the order's other state starts, a
        third after some weeks, the rest are open."""
        ends = [K.DIED, K.DEFAULTED, K.STOPPED, K.TRANSFERRED_OUT]
        state = f"case when k % 10 <= 5 then {quoted(K.ON_ART)} else {pick(ends, 'k % 10 - 6')} end"
        place = facility("(p + if(k % 7 = 0, 1, 0)) % 5")
        later = f"date_add(d, {EXTRA_STATE_DAYS})"
        treat = self._orders.selectExpr(
            "k as program_state_id", "p as patient_id", f"{state} as state", f"{place} as location", "d as start_date",
            f"case when k % 3 = 0 then {later} when k % 3 = 1 then date_add(d, cast(k % 90 + 30 as int)) end as end_date")
        extra = self._orders.selectExpr(
            f"k + {EXTRA_STATE_ID_OFFSET} as program_state_id", "p as patient_id",
            f"if(k % 2 = 0, {quoted(K.PRE_ART_CONTINUE)}, {quoted(K.EXPOSED_CHILD_CONTINUE)}) as state",
            f"{place} as location", f"{later} as start_date", "cast(null as date) as end_date")
        return treat.unionByName(extra).selectExpr(
            "program_state_id", "patient_id as program_enrollment_id", "patient_id", f"{quoted(K.HIV_PROGRAM)} as program",
            f"{quoted(K.TREATMENT_WORKFLOW)} as workflow", "state", "location", "start_date", "end_date")

    @functools.cached_property
    def omrs_program_enrollment(self) -> DataFrame:
        return self._customers.selectExpr(
            "p as program_enrollment_id", "p as patient_id", "if(p % 3 = 0, date '2001-12-31', null) as completion_date",
            f"if(p % 3 = 0, {quoted(K.TRANSFERRED_OUT)}, null) as outcome")

    @functools.cached_property
    def omrs_patient_identifier(self) -> DataFrame:
        arv = f"if(p % 17 = 0, 'ARV number', {quoted(K.ARV_NUMBER)})"

        def rows(variant: int, place: str, number: str, kind: str, cond: str = "true") -> DataFrame:
            return self._customers.where(cond).selectExpr(
                f"p * 10 + {variant} as patient_identifier_id", "p as patient_id", f"{kind} as type", f"{number} as identifier",
                f"{facility(place)} as location", f"date_add(date_add(date '1995-01-01', cast(p % 97 as int)), {variant}) as date_created")

        return (rows(0, "p % 5", "concat('NNO ', cast(p as string))", arv)
                .unionByName(rows(1, "(p + 1) % 5", "concat('ALT ', cast(p as string))", arv, "p % 11 = 0"))
                .unionByName(rows(2, "p % 5", "concat('NNO ', cast(p as string), ' 2')", arv, "p % 29 = 0"))
                .unionByName(rows(3, "p % 5", "concat('HCC ', cast(p as string))", quoted(K.HCC_NUMBER), "p % 4 = 0")))

    @functools.cached_property
    def lookup_location(self) -> DataFrame:
        """Facility name -> key.  A constant dimension."""
        return self.spark.createDataFrame(
            [(name, i) for i, name in enumerate(K.FACILITIES)],
            "target_value string, source_key int")

    # -- warehouse tables ------------------------------------------------------
    @functools.cached_property
    def _initial_k(self) -> DataFrame:
        return self._orders.selectExpr(
            "k", "p as patient_id", "d as visit_date", f"{facility('p % 5')} as location",
            "if(k % 5 != 0, cast((k * 37) % 600 as int), null) as cd4_count", "if(k % 6 = 0, d, null) as transfer_in_date",
            f"if({FEMALE}, {pick(PREGNANCY_CYCLE, 'floor(k / 8) % 4')}, null) as pregnant_or_lactating")

    @functools.cached_property
    def mw_art_initial(self) -> DataFrame:
        return self._initial_k.drop("k")

    @functools.cached_property
    def _followup_k(self) -> DataFrame:
        neno_clinics = [c for c, par in K.OUTREACH_PARENT if par == K.FACILITIES[0]]
        outreach = (f"case when p % 5 = 0 then {pick(neno_clinics, 'floor(k / 13) % 3')} when p % 5 = 1 then 'Felemu Outreach Clinic' "
                    "else 'Kasamba Outreach Clinic' end")
        pills = "cast(12 * (k % 4 + 1) as decimal(10,2))"
        drugs = [("inh_300", K.ISONIAZID, "k % 4 in (0, 1)"), ("rfp_150", K.RIFAPENTINE, "k % 4 = 1"), ("rfp_inh", K.RFP_INH, "k % 12 = 2")]
        return self._orders.selectExpr(
            "k", "p as patient_id", "d as visit_date",
            f"case when k % 13 = 1 and p % 5 <= 2 then {outreach} else {facility('p % 5')} end as location",
            "if(k % 23 != 0, date_add(d, cast(28 * (k % 7 + 1) as int)), null) as next_appointment_date",
            f"{pick(REGIMEN_CYCLE, f'(k * 31 + p) % {len(REGIMEN_CYCLE)}')} as art_regimen",
            "if(k % 17 != 0, cast(cast((k * 13) % 900 as decimal(10,2)) / 10 as decimal(10,2)), null) as weight",
            "cast(30 * (k % 6 + 1) as int) as arvs_given",
            "if(k % 5 != 0, cast(k % 70 + 100 as int), null) as systolic_bp", "if(k % 5 != 0, cast(k % 50 + 60 as int), null) as diastolic_bp",
            f"{pick(K.TB_STATUSES, 'floor(k / 4) % 4')} as tb_status",
            *[x for name, drug, given in drugs for x in (f"if({given}, {quoted(drug)}, null) as {name}", f"if({given}, {pills}, null) as {name}_pills")],
            f"if({FEMALE}, {pick(PREGNANCY_CYCLE, 'floor(k / 2) % 4')}, null) as pregnant_or_lactating")

    @functools.cached_property
    def mw_art_followup(self) -> DataFrame:
        return self._followup_k.drop("k")

    @functools.cached_property
    def mw_art_visits(self) -> DataFrame:
        """Follow-up and initial visits; ids 2k+1 / 2k (unique without a global sort)."""
        fu = self._followup_k.selectExpr(
            "k * 2 + 1 as art_visit_id", "patient_id", "visit_date", "location", "art_regimen as art_drug_regimen", "next_appointment_date")
        ini = self._initial_k.selectExpr(
            "k * 2 as art_visit_id", "patient_id", "visit_date", "location",
            "cast(null as string) as art_drug_regimen", "cast(null as date) as next_appointment_date")
        return fu.unionByName(ini)

    @functools.cached_property
    def mw_art_viral_load(self) -> DataFrame:
        return self._orders.selectExpr(
            "p as patient_id", "d as visit_date", f"{facility('p % 5')} as location",
            f"if(k % 2 = 0, {quoted(K.ROUTINE)}, {quoted(K.TARGET)}) as reason_for_test",
            "if(k % 4 = 0, cast((k * 97) % 3000 as int), null) as viral_load_result", "if(k % 4 = 1, 400, null) as less_than_limit",
            f"if(k % 4 = 2, {quoted(K.LDL_TRUE)}, null) as ldl", "if(k % 4 = 3, 'Sample rejected', null) as other_results")

    @functools.cached_property
    def mw_art_followup_testing(self) -> DataFrame:
        return self._orders.selectExpr(
            "p as patient_id", "d as visit_date", f"{facility('p % 5')} as location", "cast((k * 53) % 800 as int) as cd4_count")

    # -- EAV source (inputs of the warehouse loaders) ---------------------------
    @functools.cached_property
    def omrs_encounter(self) -> DataFrame:
        return self._orders.selectExpr(
            "k as encounter_id", "p as patient_id", "d as encounter_date",
            f"{pick(K.ENCOUNTER_TYPES, f'k % {len(K.ENCOUNTER_TYPES)}')} as encounter_type", f"{facility('p % 5')} as location")

    @functools.cached_property
    def omrs_obs(self) -> DataFrame:
        from kalulu.plans.loaders.concepts import ALL_CODED, ALL_CONCEPTS

        concept = pick(ALL_CONCEPTS, f"(l_partkey + l_linenumber) % {len(ALL_CONCEPTS)}")
        coded = pick(ALL_CODED, f"(l_partkey * 3 + l_suppkey) % {len(ALL_CODED)}")
        return read_parquet(self.spark, self.base, "lineitem").selectExpr(
            "l_orderkey as encounter_id", "l_orderkey * 10 + l_linenumber as obs_group_id", f"{concept} as concept",
            "cast(l_shipdate as date) as obs_date", f"{coded} as value_coded", "cast(l_quantity as decimal(16,4)) as value_numeric",
            "cast(l_shipdate as date) as value_date", "concat('T', cast(l_partkey as string)) as value_text",
            "date_add(cast(l_shipdate as date), cast(l_suppkey % 30 as int)) as date_created")

    @functools.cached_property
    def omrs_obs_group(self) -> DataFrame:
        """One row per observation group (construct) with its concept."""
        from kalulu.plans.loaders.concepts import GROUP_CONCEPTS

        concept = pick(GROUP_CONCEPTS, f"(l_orderkey + l_linenumber) % {len(GROUP_CONCEPTS)}")
        return read_parquet(self.spark, self.base, "lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber as obs_group_id", "l_orderkey as encounter_id", f"{concept} as concept").distinct()

    @functools.cached_property
    def omrs_patient(self) -> DataFrame:
        return read_parquet(self.spark, self.base, "customer").selectExpr(
            "c_custkey as patient_id", "c_name as identifier", "if(c_custkey % 2 = 0, 'F', 'M') as gender",
            f"date_sub(date '{ANCHOR}', cast((c_custkey * 7919) % 33000 as int)) as birthdate", "c_custkey % 9 = 0 as birthdate_estimated",
            "'Neno' as state_province", "concat('TA ', cast(c_nationkey as string)) as county_district",
            "concat('Village ', cast(c_custkey % 40 as string)) as city_village", "c_custkey % 23 = 0 as dead",
            "if(c_custkey % 23 = 0, date '2001-01-01', null) as death_date", "concat('uuid-', cast(c_custkey as string)) as patient_uuid")

    @functools.cached_property
    def omrs_relationship(self) -> DataFrame:
        return self._orders.selectExpr(
            "k as relationship_id", "p as patient_id", "concat('CHW ', cast(k % 50 as string)) as related_person",
            "if(k % 3 != 0, 'Community Health Worker', 'Guardian') as related_person_role", "if(k % 4 != 0, d, null) as start_date",
            "if(k % 5 = 0, date_add(d, 365), null) as end_date", "date_add(d, cast(k % 11 as int)) as date_created")
