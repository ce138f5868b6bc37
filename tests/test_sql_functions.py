"""Functions called in SQL give what the queries give."""

import datetime as dt

import pytest

import __spark_entry__ as E
from kalulu.plans import functions_queries as Q
from kalulu.plans.loaders.concepts import BREASTFEEDING_STOPPED
from kalulu.plans.cohort import hiv_cohort, last_outcome_at_facility
from kalulu.plans.reports.cohort_disaggregated import cohort_disaggregated
from kalulu.plans.reports.mmd import tx_mmd
from kalulu.plans.reports.screening import tx_hiv_htn
from kalulu.params import ReportParams
from kalulu.plans.sql_functions import TABLES, register_functions
from kalulu.sources.bucketed import READ_CONF, BucketedWarehouse, write_bucketed
from kalulu.sources.fixtures import Warehouse
from kalulu.sources.warehouse import LoadedWarehouse

START, END = dt.date(2000, 4, 1), dt.date(2000, 6, 30)


@pytest.fixture(scope="module")
def loaded(spark):
    """The loaders' lab tests, regimens and child visits beside the fixture's other tables."""
    source = Warehouse(spark, E.SF_SMOKE)
    new = LoadedWarehouse(source)

    class Both:
        pass
    wh = Both()
    wh.spark = spark
    for t in TABLES:
        setattr(wh, t, getattr(new if t in ("mw_lab_tests", "mw_art_regimen", "mw_eid_visits") else new.source, t))
    assert set(register_functions(wh)) >= {"latest_test_result", "tx_mmd", "hiv_cohort", "parent_health_facility"}
    yield wh
    for t in TABLES:
        spark.catalog.dropTempView(t)


def _same(sql_rows, rows):
    columns = rows.columns
    assert sorted(sql_rows.columns) == sorted(columns)
    got, want = (sorted(map(str, df.select(*columns).collect())) for df in (sql_rows, rows))
    assert got == want and want


def test_lookups(spark, loaded):
    lab, lo, hi = loaded.mw_lab_tests, *E.BOUNDS
    _same(spark.sql("select * from latest_test_result('HIV test', null, null, 0)"), Q.latest_test_result(lab, "HIV test"))
    _same(spark.sql("select * from latest_test_result('Viral Load', null, null, 1)"), Q.latest_test_result(lab, "Viral Load", 1))
    _same(spark.sql(f"select * from latest_test_result('HIV test', date'{lo}', date'{hi}', 0)"), Q.latest_test_result(lab, "HIV test", 0, lo, hi))
    _same(spark.sql(f"select * from first_test_result('Viral Load', date'{END}')"), Q.first_test_result(lab, "Viral Load", END))
    _same(spark.sql("select * from latest_test_by_sample_date('HIV test', null, null, 0)"), Q.latest_test_by_sample_date(lab, "HIV test"))
    _same(spark.sql("select * from regimen_line(1)"), Q.regimen_at_offset(loaded.mw_art_regimen, 1))
    day, stopped = lambda n: dt.date(2000, n, 1), BREASTFEEDING_STOPPED
    visits = spark.createDataFrame(
        [(1, day(1), stopped), (1, day(2), "Breastfeeding"), (1, day(3), stopped), (2, day(8), stopped), (3, day(2), "Breastfeeding"),
         (4, day(4), stopped), (4, day(3), "Breastfeeding"), (5, day(5), None), (None, day(5), stopped)],
        "patient_id bigint, visit_date date, breastfeeding_status string")
    visits.createOrReplaceTempView("mw_eid_visits")
    _same(spark.sql(f"select * from first_date_no_breastfeeding(date'{END}')"), Q.first_date_no_breastfeeding(visits, END))
    plan = spark.sql("select * from latest_test_result('HIV test', null, null, 0)")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "NestedLoop" not in plan
    row = spark.sql("select parent_health_facility('Kasamba Outreach Clinic '), parent_health_facility('x'), formatted_identifier('NNO 12 ab'), "
                    "parent_health_facility(null), formatted_identifier(null)").first()
    assert tuple(row) == ("Midzemba HC", "x", "NNO-0012-ab", None, None)


def test_cohorts_and_reports(spark, loaded):
    p = ReportParams(START, END)
    _same(spark.sql(f"select * from last_outcome_at_facility(date'{END}')"), last_outcome_at_facility(loaded, END).drop("location_key"))
    _same(spark.sql(f"select * from hiv_cohort(date'{START}', date'{END}')"), hiv_cohort(loaded, p))
    _same(spark.sql(f"select * from cohort_disaggregated(date'{START}', date'{END}', 60)"), cohort_disaggregated(loaded, START, END, cutoff=60))
    _same(spark.sql(f"select * from tx_hiv_htn(date'{END}', 30)"), tx_hiv_htn(loaded, END, cutoff=30))
    for end, cutoff in ((END, 60), (END, 30), (dt.date(2000, 6, 15), 30)):
        _same(spark.sql(f"select * from tx_mmd(date'{end}', {cutoff})"), tx_mmd(loaded, end, cutoff=cutoff))
    one = spark.sql(f"select * from tx_mmd(date'{END}', 60) where location = 'Neno District Hospital'")
    assert one.count() == 44
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_functions_kept_in_a_database(spark, tmp_path):
    source = Warehouse(spark, E.SF_SMOKE)
    tables = ["mw_patient", "mw_art_followup", "mw_art_initial", "omrs_program_state", "omrs_patient_identifier", "lookup_location"]
    write_bucketed(source, "kalulu_fn", 4, tables, str(tmp_path / "db"))
    try:
        stored = BucketedWarehouse(spark, "kalulu_fn")
        names = register_functions(stored)
        assert "tx_mmd" in names and "latest_test_result" not in names          # there are no lab tests in this database
        spark.sql("drop temporary function if exists tx_mmd")                   # it would come first
        spark.sql("use kalulu_fn")
        _same(spark.sql(f"select * from tx_mmd(date'{END}', 60)"), tx_mmd(stored, END))
        assert spark.sql("select kalulu_fn.parent_health_facility('Felemu Outreach Clinic')").first()[0] == "Chifunga HC"
    finally:
        spark.sql("use default")
        spark.sql("drop database kalulu_fn cascade")
        for k in READ_CONF:
            spark.conf.unset(k)
