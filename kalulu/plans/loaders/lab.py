"""mw_lab_tests: viral-load and HIV tests in one table with ids.

Every observation keeps its row: the inputs are full outer joins, as in the
source, so a result without a sample (or the reverse) is a test of its own and
several results of one encounter are several tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.operators.ids import dense_ids
from kalulu.plans.loaders import concepts as C
from kalulu.sources.fixtures import Warehouse

COLUMNS = ["patient_id", "encounter_id", "date_collected", "test_type", "date_result_received",
           "date_result_entered", "result_coded", "result_numeric", "result_exception"]


def _observations(wh: Warehouse, concepts: list[str]) -> DataFrame:
    enc = wh.omrs_encounter.select("encounter_id", "patient_id", "encounter_date")
    return wh.omrs_obs.where(F.col("concept").isin(concepts)).join(enc, "encounter_id")


def _viral_loads(wh: Warehouse) -> DataFrame:
    """Viral loads: samples, LDL results, "<limit" results and numeric results,
    full outer joined by (patient, encounter)."""
    obs = _observations(wh, [C.VL_SAMPLE, C.VL_LDL, C.VL_LESS_THAN, C.VL_RESULT])
    keys = ["patient_id", "encounter_id"]

    def part(concept: str, prefix: str, true_only: bool) -> DataFrame:
        rows = obs.where(F.col("concept") == concept)
        if true_only:
            rows = rows.where(F.col("value_coded") == "True")
        return rows.select(*keys, F.col("obs_date").alias(f"{prefix}_date"), F.col("date_created").alias(f"{prefix}_entered"),
                           F.col("value_numeric").alias(f"{prefix}_value"), F.lit(True).alias(f"{prefix}_here"))
    tests = (part(C.VL_SAMPLE, "s", True).join(part(C.VL_LDL, "l", True), keys, "full")
             .join(part(C.VL_LESS_THAN, "t", False), keys, "full").join(part(C.VL_RESULT, "r", False), keys, "full"))
    return tests.select(
        *keys, F.coalesce("s_date", "l_date", "t_date", "r_date").alias("date_collected"),
        F.lit(C.VL_TEST_TYPE).alias("test_type"), F.lit(None).cast("date").alias("date_result_received"),
        F.coalesce("l_entered", "t_entered", "r_entered").alias("date_result_entered"),
        F.lit(None).cast("string").alias("result_coded"),
        F.col("r_value").cast("decimal(10,2)").alias("result_numeric"),
        F.coalesce(F.when(F.col("l_here"), F.lit(C.VL_LDL_TEXT)),
                   F.concat(F.lit("<"), F.col("t_value").cast("string"))).alias("result_exception"))


def _hiv_tests(wh: Warehouse) -> DataFrame:
    """HIV tests: child serology constructs, all HIV results and the constructs'
    sample dates, full outer joined by (patient, observation group), then test
    type and date received; the collection date falls back to the construct's
    encounter date and the type to 'HIV test'."""
    keys = ["patient_id", "obs_group_id"]
    constructs = wh.omrs_obs_group.where(F.col("concept") == C.SEROLOGY_CONSTRUCT)
    visits = wh.omrs_encounter.select("encounter_id", "patient_id", "encounter_date")
    groups = constructs.join(visits, "encounter_id").select(*keys, "encounter_id", "encounter_date")
    obs = _observations(wh, [C.HIV_SAMPLE_DATE, C.HIV_RESULT_DATE, C.HIV_RESULT, C.HIV_TEST_TYPE])

    def of(concept: str, *columns) -> DataFrame:
        return obs.where(F.col("concept") == concept).select(*keys, *columns)
    samples = of(C.HIV_SAMPLE_DATE, F.col("value_date").alias("sample_date")).join(
        constructs.select("obs_group_id"), "obs_group_id", "left_semi")
    tests = (groups.join(of(C.HIV_RESULT, F.col("value_coded").alias("result_coded"),
                            F.col("date_created").alias("date_result_entered")), keys, "full")
             .join(samples, keys, "full")
             .join(of(C.HIV_TEST_TYPE, F.col("value_coded").alias("type")), keys, "left")
             .join(of(C.HIV_RESULT_DATE, F.col("value_date").alias("date_result_received")), keys, "left"))
    return tests.select(
        "obs_group_id", "patient_id", "encounter_id", F.coalesce("sample_date", "encounter_date").alias("date_collected"),
        F.coalesce("type", F.lit(C.HIV_DEFAULT_TEST_TYPE)).alias("test_type"), "date_result_received",
        "date_result_entered", "result_coded", F.lit(None).cast("decimal(10,2)").alias("result_numeric"),
        F.lit(None).cast("string").alias("result_exception"))


def load_lab_tests_vl(wh: Warehouse) -> DataFrame:
    """The viral loads of mw_lab_tests; their ids are those of the whole table."""
    return dense_ids(_viral_loads(wh), "lab_test_id", COLUMNS).select("lab_test_id", *COLUMNS)


def load_lab_tests_hiv(wh: Warehouse) -> DataFrame:
    """The HIV tests alone, numbered from 1."""
    return dense_ids(_hiv_tests(wh), "lab_test_id", [*COLUMNS, "obs_group_id"]).select("lab_test_id", *COLUMNS)


def load_lab_tests(wh: Warehouse) -> DataFrame:
    """mw_lab_tests: both kinds, appended and numbered through, viral loads first."""
    both = _viral_loads(wh).withColumns({"kind": F.lit(0), "obs_group_id": F.lit(None).cast("long")}).unionByName(
        _hiv_tests(wh).withColumn("kind", F.lit(1)))
    return dense_ids(both, "lab_test_id", ["kind", *COLUMNS, "obs_group_id"]).select("lab_test_id", *COLUMNS)
