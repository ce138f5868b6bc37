"""Age and weight banding plus the constant band dimensions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.sqltext import quoted


@functools.cache
def age_case(age: str) -> str:
    # the lowest band is open below (an age under 12 months of any sign)
    arms = " ".join(f"when {age} >= {lower} then {quoted(label)}" if lower > 0 else f"when {age} is not null then {quoted(label)}"
                    for label, lower in reversed(K.AGE_BANDS))
    return f"case {arms} end"


def age_band(age_months: str, gender: str) -> Column:
    """Band label for an age in 30-day months; null when gender is not M/F.  Both are column names."""
    return F.expr(f"if({gender} in ('M', 'F'), {age_case(age_months)}, null)")


@functools.cache
def _weight_case(weight: str) -> str:
    arms = " ".join(f"when cast({weight} as decimal(10,0)) >= {lower} then {quoted(label)}" for label, lower in reversed(K.WEIGHT_BANDS))
    return f"case when {weight} is null then {quoted(K.WEIGHT_UNKNOWN)} {arms} end"


def weight_band(weight: str) -> Column:
    """Band of the weight (a column name) rounded half-up to an integer; 'Unknown' when null;
    null (dropped by the dimension join) when the rounded weight is below 3."""
    return F.expr(_weight_case(weight))


@functools.cache
def _dimension_rows(labels: tuple[str, ...], band_col: str) -> str:
    rows = [(g, label) for g in ("F", "M") for label in labels]
    return ", ".join(f"named_struct('sort_value', {n}, '{band_col}', {quoted(label)}, 'gender', '{g}')" for n, (g, label) in enumerate(rows, 1))


def band_dimension(locations: DataFrame, labels: list[str], band_col: str) -> DataFrame:
    """(location, sort_value, band, gender) rows: every band for F then M, per location.

    Generated by exploding a literal array per location row, so the
    dimension grows with the facility table and needs no cross join.
    """
    return locations.selectExpr("location", f"inline(array({_dimension_rows(tuple(labels), band_col)}))")


def age_labels() -> list[str]:
    return [label for label, _ in K.AGE_BANDS]


def weight_labels() -> list[str]:
    return [label for label, _ in K.WEIGHT_BANDS] + [K.WEIGHT_UNKNOWN]
