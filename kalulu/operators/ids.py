"""Row numbers over a whole table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.session import checkpoint


def dense_ids(df: DataFrame, name: str, order: Sequence[str], first: int = 1) -> DataFrame:
    """``df`` with a column ``name`` in front: first, first + 1, ... in the order of the columns ``order``, nulls first.

    The rows are range-partitioned by ``order`` and sorted within the
    partitions (no window); the partitions' counts, one number each, are added
    up on the driver and give every partition its offset.  Equal rows get ids of their own: a
    row's place breaks ties, so they are spread over partitions too.  The
    ordered rows are checkpointed, so that counts and rows are of one layout
    and the ids do not change when a task is run again.
    """
    placed = df.withColumn("__place", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in (*order, "__place")]
    ordered = checkpoint(placed.repartitionByRange(*by).sortWithinPartitions(*by).drop("__place").withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()      # one row a partition
    before = [0, *accumulate(r.n for r in counts)]
    offsets = df.sparkSession.createDataFrame([(r.part, n) for r, n in zip(counts, before)], "__part bigint, __before bigint")
    row = F.col("__at").bitwiseAND((1 << 33) - 1)
    return ordered.withColumn("__part", part).join(offsets, "__part").select((F.col("__before") + row + first).alias(name), *df.columns)
