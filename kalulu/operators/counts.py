"""Banded conditional counts, zero fill and the appended group rows.

Every banded report is: rows -> ``groupBy(location, band, gender)`` with one
``count_if`` per indicator (partial aggregation, so hot facilities are
combined map-side) -> left join onto the band dimension -> nulls to 0.

:func:`report_counts` adds the four "All" rows per facility in the same pass: a
row goes to its band and to its population group, one aggregate counts both,
one dimension fills both.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu import constants as K
from kalulu.functions.sqltext import quoted
from kalulu.operators.bands import band_dimension


def count_if(pred: Column) -> Column:
    """COUNT(IF(pred, 1, NULL)): only TRUE counts; NULL predicates do not."""
    return F.count(F.when(pred, F.lit(1))).cast("bigint")


def _counts(indicators) -> list[Column]:
    return [F.expr(f"count_if(`__p_{n}`) as `{n}`") for n in indicators]


def _filled(indicators) -> list[str]:
    return [f"coalesce(`{n}`, 0L) as `{n}`" for n in indicators]


def banded_counts(rows: DataFrame, locations: DataFrame, band: Column, gender: Column,
                  indicators: dict[str, Column], labels: list[str],
                  band_col: str = "age_group") -> DataFrame:
    """Detail rows: one per (location, band, gender) of the dimension, zero filled."""
    counted = (rows.select("location", band.alias(band_col), gender.alias("__g"),
                           *[p.alias(f"__p_{n}") for n, p in indicators.items()])
               .where(F.col(band_col).isNotNull())
               .groupBy("location", band_col, "__g")
               .agg(*_counts(indicators)))
    dim = band_dimension(locations, labels, band_col)
    joined = dim.join(counted.withColumnRenamed("__g", "gender"), ["location", band_col, "gender"], "left")
    return joined.selectExpr("location", "sort_value", band_col, "if(gender = 'F', 'Female', 'Male') as gender", *_filled(indicators))


def group_label(gender: str, pregnancy: str) -> str:
    """SQL text: the population group of a row.  The four groups exclude each
    other (male; female pregnant / not pregnant or unknown / breastfeeding);
    other rows get null."""
    female = {K.PREGNANT: "FP", K.NOT_PREGNANT: "FNP", K.BREASTFEEDING: "FBF"}
    arms = " ".join(f"when {gender} = 'F' and {pregnancy} = {quoted(v)} then '{g}'" for v, g in female.items())
    return f"case when {gender} = 'M' then 'Male' {arms} when {gender} = 'F' and {pregnancy} is null then 'FNP' end"


def group_weights(gender: str, pregnancy: str) -> list[Column]:
    """Aggregates ``w_<group>``: how many rows of a key are of each group."""
    label = group_label(gender, pregnancy)
    return [F.expr(f"count_if({label} = '{g}') as w_{g}") for g in K.GROUPS]


#: group labels and weights for rows that carry the sums of :func:`group_weights`
WEIGHTED = {f"'{g}'": f"w_{g}" for g in K.GROUPS}


@functools.cache
def report_dimension(labels: tuple[str, ...], band_col: str) -> str:
    keys = [(label, g) for g in ("Female", "Male") for label in labels] + [("All", g) for g in K.GROUPS]
    return ", ".join(f"named_struct('sort_value', {i}, '{band_col}', {quoted(label)}, 'gender', '{g}')" for i, (label, g) in enumerate(keys, 1))


def report_counts(rows: DataFrame, locations: DataFrame, band: Column, gender: str, groups: dict[str, str],
                  indicators: dict[str, Column], labels: list[str], detail: str = "1",
                  band_col: str = "age_group") -> DataFrame:
    """Detail rows (band x sex) and the four "All" rows per facility, zero filled, from one pass over ``rows``.

    A row counts ``detail`` times for its band and, for each entry of
    ``groups`` (label -> weight, SQL texts), weight times for that population
    group; null labels and weights of 0 or null count nowhere.  What a join to
    cohort rows would repeat is thus counted by weights, not by rows.  One
    partial aggregate with one key for both kinds, one join onto the dimension.
    """
    slots = ", ".join([
        f"named_struct('{band_col}', __band, 'gender', case `{gender}` when 'F' then 'Female' when 'M' then 'Male' end, '__n', cast({detail} as bigint))",
        *[f"named_struct('{band_col}', 'All', 'gender', {label}, '__n', cast({weight} as bigint))" for label, weight in groups.items()]])
    tests = [p.alias(f"__p_{n}") for n, p in indicators.items()]
    flat = rows.withColumn("__band", band).select("*", *tests).selectExpr(
        "location", *[f"`__p_{n}`" for n in indicators], f"inline(array({slots}))")
    counted = flat.where(f"{band_col} is not null and gender is not null and __n > 0").groupBy("location", band_col, "gender").agg(
        *[F.expr(f"sum(if(`__p_{n}`, __n, 0L)) as `{n}`") for n in indicators])
    dim = locations.selectExpr("location", f"inline(array({report_dimension(tuple(labels), band_col)}))")
    return dim.join(counted, ["location", band_col, "gender"], "left").selectExpr(
        "location", "sort_value", band_col, "gender", *_filled(indicators))
