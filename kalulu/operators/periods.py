"""Several reporting periods in one pass (no per-period job, no cross join).

A report that is re-run for a list of period ends (21 yearly cohorts, three
consecutive months) is expressed once: every fact row is tagged with the
periods it belongs to, and the as-of aggregates are computed per period key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu.functions.dates import date_text


def oldest_period_index(date: str, ends: Sequence[_dt.date]) -> Column:
    """For period ends E_0 > E_1 > ... the largest i with ``date <= E_i``
    (null when the date is after E_0): the row is "as of" every period 0..i."""
    arms = " ".join(f"when {date} <= {date_text(ends[i])} then {i}" for i in reversed(range(len(ends))))
    return F.expr(f"case {arms} end")


def period_in_range(date: str, starts: Sequence[_dt.date], ends: Sequence[_dt.date]) -> Column:
    """Index of the (disjoint) period [start_i, end_i] containing the date (a column name), else null."""
    arms = " ".join(f"when {date} between {date_text(s)} and {date_text(e)} then {i}" for i, (s, e) in enumerate(zip(starts, ends)))
    return F.expr(f"case {arms} end")


def latest_as_of_periods(df: DataFrame, keys: Sequence[str], date_col: str, ends: Sequence[_dt.date],
                         order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per (keys, period): the greatest row by ``order`` with date <= end_i.

    Pre-aggregates per (keys, oldest period index) -- a partial aggregate over
    the full table -- and only then fans the (at most len(ends)) summary rows
    of a key out to the periods they cover, aggregating once more.
    """
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])
    j = oldest_period_index(date_col, ends)
    summary = (df.withColumn("__j", j).where(F.col("__j").isNotNull())
               .groupBy(*keys, "__j").agg(F.max(packed).alias("__r")))
    fanned = summary.withColumn("period", F.explode(F.sequence(F.lit(0), F.col("__j"))))
    best = fanned.groupBy(*keys, "period").agg(F.max("__r").alias("__r"))
    return best.select(*keys, "period", *[F.col(f"__r.{c}").alias(c) for c in (*order, *payload)])


def max_as_of_periods(df: DataFrame, key: str, date_col: str, ends: Sequence[_dt.date]) -> DataFrame:
    """(key, period, MAX(date) with date <= end_i) from one partial aggregate."""
    j = oldest_period_index(date_col, ends)
    summary = (df.withColumn("__j", j).where(F.col("__j").isNotNull())
               .groupBy(key, "__j").agg(F.max(date_col).alias("__m")))
    fanned = summary.withColumn("period", F.explode(F.sequence(F.lit(0), F.col("__j"))))
    return fanned.groupBy(key, "period").agg(F.max("__m").alias(date_col))


def rows_at_max_per_period(df: DataFrame, key: str, date_col: str, ends: Sequence[_dt.date]) -> DataFrame:
    """Every row at the key's MAX date <= end_i, per period (ties kept); adds ``period``."""
    return df.join(max_as_of_periods(df, key, date_col, ends), [key, date_col], "inner")
