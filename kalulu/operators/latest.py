"""As-of operators: latest / earliest row per key.

The first three are built from a *partial* aggregate (map-side combine before the
shuffle), so a key that holds a third of all rows costs one combined buffer
per task, never one giant sorted window partition.

* :func:`latest_per_key` -- exactly one row per key, total order given
  (``max(struct(order..., payload...))``).
* :func:`rows_at_extreme` -- every row at the key's MAX / MIN date, ties kept
  (aggregate the date, join back on key + date).
* :func:`tag_extremes` -- several extremes of one table in a single aggregate
  pass, joined back once (the cohort uses four of them).
* :func:`nth_latest` -- the (n+1)-th newest row (``ORDER BY .. LIMIT 1 OFFSET n``),
  a ranked window whose rows are limited per key before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   payload: Sequence[str] | None = None, newest: bool = True) -> DataFrame:
    """One row per key: the row that is greatest (``newest``) or least by ``order``.

    ``order`` must be a total order within a key for a deterministic result.
    Nulls in ``order`` rank lowest, as in the source: last when newest comes
    first, first in ascending order; a key with nulls only still has a row.
    """
    payload = [c for c in (payload if payload is not None else df.columns)
               if c not in keys and c not in order]
    fields = ", ".join(f"`{c}`" for c in (*order, *payload))
    return df.groupBy(*keys).agg(F.expr(f"{'max' if newest else 'min'}(struct({fields})) as __r")).select(*keys, "__r.*")


def rows_at_extreme(df: DataFrame, keys: Sequence[str], date_col: str,
                    newest: bool = True) -> DataFrame:
    """All rows of each key whose ``date_col`` equals the key's MAX (or MIN); ties kept."""
    ext = df.groupBy(*keys).agg(F.expr(f"{'max' if newest else 'min'}(`{date_col}`) as `{date_col}`"))
    return df.join(ext, [*keys, date_col], "inner")


def tag_extremes(df: DataFrame, key: str, date_col: str,
                 specs: dict[str, tuple[str, Column]]) -> DataFrame:
    """Attach, for every spec ``name -> ('max'|'min', condition)``, the key's
    extreme ``date_col`` among rows meeting the condition as column ``name``.

    One partial aggregate over ``df`` and one join back on ``key``: the table
    is shuffled once by ``key`` and every consumer downstream stays
    co-partitioned on it.
    """
    aggs = []
    for name, (how, cond) in specs.items():
        v = F.when(cond, F.col(date_col))
        aggs.append((F.max(v) if how == "max" else F.min(v)).alias(name))
    ext = df.groupBy(key).agg(*aggs)
    return df.join(ext, key, "inner")


def nth_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 0,
               payload: Sequence[str] | None = None, newest: bool = True) -> DataFrame:
    """The (n+1)-th row per key by ``order`` (``ORDER BY .. DESC LIMIT 1 OFFSET n``
    for ``newest``; nulls rank lowest, i.e. last when newest first).

    ``n`` is a small constant (the offset of a regimen line or test).  One scan
    and one shuffle: the rank filter lets Spark keep the first n+1 rows of a key
    in each task before the shuffle (window group limit), so a key that holds a
    third of all rows arrives as n+1 rows per task.  Ties on ``order`` are broken
    by the payload values.
    """
    payload = [c for c in (payload if payload is not None else df.columns)
               if c not in keys and c not in order]
    cols = [*order, *payload]
    by = [F.col(c).desc_nulls_last() if newest else F.col(c).asc_nulls_first() for c in cols]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.select(*keys, *cols, rank.alias("__rank")).where(F.col("__rank") <= n + 1).where(
        F.col("__rank") == n + 1).select(*keys, *cols)
