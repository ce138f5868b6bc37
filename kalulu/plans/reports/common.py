"""Shared report plumbing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.functions.dates import lit_date
from kalulu.operators.latest import rows_at_extreme
from kalulu.params import ReportParams
from kalulu.sources.fixtures import Warehouse


def latest_followup(wh: Warehouse, p: ReportParams) -> DataFrame:
    """Follow-up rows at each patient's latest visit date <= end (ties kept)."""
    fu = wh.mw_art_followup.where(F.col("visit_date") <= lit_date(p.end))
    return rows_at_extreme(fu, ["patient_id"], "visit_date")


def order_report(df: DataFrame) -> DataFrame:
    return df.orderBy("location", "sort_value")
