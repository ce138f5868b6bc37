"""Existence of a date in a range, per key: a sorted array and a binary search.

A semi join on a range predicate (does SOME date of the key lie within ..?)
meets every date of a key with every probe of it.  Here a key's distinct dates
are one sorted array (at most one entry per calendar day, however many rows),
joined to the probes by key, and each probe is a search of log2(size) steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_dates(df: DataFrame, key: str, date_col: str, out: str) -> DataFrame:
    """One row per key: its distinct non-null dates in ascending order (keys of null dates only: an empty array)."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(date_col)).alias(out))


def dates_up_to(dates: str, bound: str) -> str:
    """SQL text: how many entries of the sorted array ``dates`` are on or before ``bound`` (both SQL texts)."""
    middle = "shiftright(s.low + s.high, 1)"
    return (f"aggregate(sequence(0, cast(log2(size({dates}) + 1) as int)), named_struct('low', 0, 'high', size({dates})), "
            f"(s, i) -> if(s.low >= s.high, s, if(get({dates}, {middle}) <= {bound}, "
            f"named_struct('low', {middle} + 1, 'high', s.high), named_struct('low', s.low, 'high', {middle}))), s -> s.low)")


def any_date_between(dates: str, low: str, high: str) -> Column:
    """Is there an entry of the sorted array within [low, high]?  Null when the array or a bound is null."""
    found = f"get({dates}, {dates_up_to(dates, high)} - 1)"
    return F.expr(f"if({dates} is null or {low} is null or {high} is null, null, coalesce({found} >= {low}, false))")
