"""Texts joined per key, with a bound (GROUP_CONCAT)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: characters that the source's GROUP_CONCAT returns at most
CONCAT_LENGTH = 1024


def joined_texts(df: DataFrame, keys: Sequence[str], value: str, out: str, separator: str = ",",
                 limit: int = CONCAT_LENGTH) -> DataFrame:
    """One row per key: its non-null values, repeats included, in ascending order, joined by ``separator`` and cut to ``limit`` characters.

    Equal values are counted before the shuffle.  Every further distinct value adds a
    character and a separator at least (the empty text the separator only), so
    about ``limit / 2`` of them, each cut to ``limit`` characters, decide the
    text: a ranked window keeps no more of a key in any task, however many it has.
    """
    if not separator:
        raise ValueError("a separator of one character or more is needed")
    most = limit // (1 + len(separator)) + 2
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(value)))
    first = counted.withColumn("__place", place).where(F.col("__place") <= most).select(
        *keys, F.struct("__place", F.expr(f"left(`{value}`, {limit})").alias("v"), F.expr(f"cast(least(__n, {limit + 1}) as int)").alias("n")).alias("__v"))
    sep = separator.replace("\\", "\\\\").replace("'", "\\'")
    # equal texts are written out only as far as the limit
    one = f"left(repeat(concat(x.v, '{sep}'), least(x.n, {limit} div (length(x.v) + {len(separator)}) + 1)), {limit + len(separator)})"
    whole = f"aggregate(array_sort(collect_list(__v)), '', (text, x) -> if(length(text) > {limit}, text, concat(text, {one})))"
    # every value brought a separator along: the last one's goes
    return first.groupBy(*keys).agg(F.expr(whole).alias("__t")).select(
        *keys, F.expr(f"if(length(__t) > {limit}, left(__t, {limit}), left(__t, length(__t) - {len(separator)}))").alias(out))
