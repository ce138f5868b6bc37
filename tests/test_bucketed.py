"""The warehouse bucketed by patient: same reports, no shuffle by patient."""

import datetime as dt

import pytest

from kalulu.plans.reports.cohort_disaggregated import cohort_disaggregated
from kalulu.plans.reports.mmd import tx_mmd
from kalulu.plans.reports.screening import tx_hiv_htn
from kalulu.plans.reports.tx_ml import tx_ml
from kalulu.sources.bucketed import READ_CONF, BucketedWarehouse, write_bucketed
from kalulu.sources.fixtures import Warehouse
from kalulu.sources.normalise import NormalisedWarehouse

START, END = dt.date(2000, 4, 1), dt.date(2000, 6, 30)
TABLES = ["mw_patient", "mw_art_followup", "mw_art_initial", "omrs_program_state", "omrs_patient_identifier", "lookup_location"]
REPORTS = {"cohort": lambda wh: cohort_disaggregated(wh, START, END), "mmd": lambda wh: tx_mmd(wh, END),
           "htn": lambda wh: tx_hiv_htn(wh, END), "ml": lambda wh: tx_ml(wh, START, END)}


@pytest.fixture()
def bucketed(spark, tmp_path):
    source = Warehouse(spark, "/root/testdata/sf0.001")
    write_bucketed(source, "kalulu_buckets", 8, TABLES, str(tmp_path / "db"))
    yield NormalisedWarehouse(source), BucketedWarehouse(spark, "kalulu_buckets")
    spark.sql("drop database kalulu_buckets cascade")
    for k in READ_CONF:
        spark.conf.unset(k)


def test_reports_over_buckets_are_equal_and_shuffle_no_patients(spark, bucketed):
    source, stored = bucketed
    with pytest.raises(AttributeError):
        stored.no_such_table
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")       # the facility list, as on large tables
    try:
        for name, report in REPORTS.items():
            plan = report(stored)._jdf.queryExecution().executedPlan().toString()
            assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(patient_id" in x], name
            assert "SelectedBucketsCount" in plan
            assert sorted(map(str, report(stored).collect())) == sorted(map(str, report(source).collect())), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_a_patient_empty_tables_and_other_columns(spark, tmp_path):
    class Tables:
        pass
    wh = Tables()
    wh.spark = spark
    full = Warehouse(spark, "/root/testdata/sf0.001").mw_patient
    wh.mw_patient = spark.createDataFrame([], full.schema)
    rows = [(None, "nno 1", "arv number ", 5), (None, "nno 2", "x", 5), (3, "", None, 5)]
    wh.omrs_patient_identifier = spark.createDataFrame(rows, "patient_id bigint, identifier string, type string, other int")
    write_bucketed(wh, "kalulu_odd", 4, ["mw_patient", "omrs_patient_identifier"], str(tmp_path / "odd"))
    write_bucketed(wh, "kalulu_odd", 4, ["mw_patient", "omrs_patient_identifier"])       # again: replaced, not added
    got = BucketedWarehouse(spark, "kalulu_odd")
    assert got.mw_patient.count() == 0
    assert got.omrs_patient_identifier.columns == ["patient_id", "type", "identifier"]
    assert sorted(map(str, got.omrs_patient_identifier.collect())) == sorted(
        ["Row(patient_id=None, type='ARV Number', identifier='nno 1')", "Row(patient_id=None, type='x', identifier='nno 2')",
         "Row(patient_id=3, type=None, identifier='')"])
    spark.sql("drop database kalulu_odd cascade")
    for k in READ_CONF:
        spark.conf.unset(k)
