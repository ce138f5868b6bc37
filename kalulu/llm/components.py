"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.llm.common import checkpoint


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang a node's neighbours (larger ones, or smaller ones and itself) on the smallest of them.

    The minimum is a partial aggregate and comes back by a join, so no task
    gathers a node's neighbours.
    """
    # both directions of an edge by one explode (a union of swapped columns
    # trips the optimizer's constraint rewriting)
    if large:
        pairs = _both(edges, ("a", "b"), ("b", "a"))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = pairs.join(least, "a")
    if large:
        hung = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = _both(joined, ("b", "m"), ("a", "m"))
    return hung.where("a <> b").distinct()


def _both(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    each = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs])
    return df.select(F.explode(each).alias("e")).select("e.a", "e.b")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges`` (a, b).

    Nodes without an edge are not returned.  Loops are ignored.  Each round is
    checkpointed; the number of rounds grows with the logarithm of the size.
    """
    now = checkpoint(edges.select("a", "b").where("a <> b").distinct())
    mark = None
    while True:
        now = checkpoint(_star(_star(now, True), False))
        new = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == (new.n, new.s):
            found = _both(now, ("a", "b"), ("b", "b"))
            return found.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
        mark = (new.n, new.s)
