"""Report invariants on the smallest driver data."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from kalulu import constants as K

SF = "/root/testdata/sf0.001"
END = dt.date(2000, 6, 30)
START = dt.date(2000, 4, 1)
F0 = K.FACILITIES[0]

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def wh(spark):
    from kalulu.sources.fixtures import Warehouse

    from kalulu.sources.normalise import NormalisedWarehouse

    return NormalisedWarehouse(Warehouse(spark, SF))


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("build", [
    lambda wh, loc: __import__("kalulu.plans.reports.mmd", fromlist=["x"]).tx_mmd(wh, END, location=loc),
    lambda wh, loc: __import__("kalulu.plans.reports.cohort_disaggregated", fromlist=["x"]).cohort_disaggregated(
        wh, START, END, location=loc),
    lambda wh, loc: __import__("kalulu.plans.reports.tx_new", fromlist=["x"]).tx_new(wh, START, END, location=loc),
    lambda wh, loc: __import__("kalulu.plans.reports.viral_load", fromlist=["x"]).regimen_by_weight(
        wh, END, location=loc),
    lambda wh, loc: __import__("kalulu.plans.reports.survival", fromlist=["x"]).survival(wh, START, END,
                                                                                        location=loc),
])
def test_single_facility_run_equals_filtered_all_facility_run(wh, build):
    one = build(wh, F0)
    all_ = build(wh, None).where(F.col("location") == F0)
    assert _rows(one) == _rows(all_)


def test_male_group_row_equals_sum_of_male_bands(wh):
    from kalulu.plans.reports.cohort_disaggregated import cohort_disaggregated

    df = cohort_disaggregated(wh, START, END)
    for loc in K.FACILITIES:
        d = df.where(F.col("location") == loc)
        bands = d.where((F.col("gender") == "Male") & (F.col("age_group") != "All")).agg(F.sum("tx_curr")).first()[0]
        group = d.where((F.col("age_group") == "All") & (F.col("gender") == "Male")).first()["tx_curr"]
        assert bands == group


def test_detail_rows_per_facility(wh):
    from kalulu.plans.reports.viral_load import regimen_by_weight

    per_loc = {r[0]: r[1] for r in regimen_by_weight(wh, END).groupBy("location").count().collect()}
    assert set(per_loc) == set(K.FACILITIES) and set(per_loc.values()) == {24}
