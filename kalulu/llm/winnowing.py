"""Document fingerprints by winnowing, in DataFrame functions only (operator 6).

Units are words (runs without ASCII blanks).  Each k-gram of words has a
rolling hash; of every window of ``window`` consecutive k-grams the smallest
hash is chosen, the rightmost on ties, and its position is kept.  Two texts
that share a run of ``window + gram - 1`` words share a chosen hash (match
guarantee); no match shorter than ``gram`` words is seen.

A chosen k-gram is one long, hash * 2^31 + (2^31 - 1 - position): the smallest
long is the smallest hash, and of equal hashes the rightmost.  Hashes and window
minima are built by doubling over arrays inside a row, without exploding words.

Texts with fewer words than ``gram`` have one hash of them all; a text without
words has an empty fingerprint, which is like another empty one (1) and unlike
any other (0).  Null texts are empty.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalulu.llm.common import NULL_ID, checked_side, parts_for, text_bytes

GRAM, WINDOW = 4, 8
MODULUS = 2 ** 31 - 1
BASE = 1_000_003
POSITIONS = 2 ** 31
RANGE_BYTES = 4 << 20     # text of the neighbouring ids that one task holds


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _doubled(a: Column, n: int, join: Callable[[Column, Column, int], Column]) -> Column:
    """From an array of units to the array of joins of n consecutive ones (at least n units)."""
    def grow(x: Column, width: int) -> Column:
        step = min(width, n - width)           # the last step overlaps unless n is a power of two
        if not step:
            return x
        size = F.size(x) - step
        return _let(F.zip_with(F.slice(x, F.lit(1), size), F.slice(x, F.lit(1 + step), size), lambda p, q: join(p, q, step)),
                    lambda y: grow(y, width + step))
    return grow(a, 1)


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.hash(w).cast("long"), F.lit(MODULUS)))


def gram_hashes(text: Column, gram: int = GRAM) -> Column:
    """Rolling hashes of all k-grams of words; of a shorter text, one of all its words."""
    if gram & (gram - 1):
        raise ValueError("gram must be a power of two: the rolling hash is built by doubling")

    def roll(p: Column, q: Column, step: int) -> Column:
        return (p * F.lit(pow(BASE, step, MODULUS)) + q) % F.lit(MODULUS)
    short = lambda h: F.when(F.size(h) == 0, h).otherwise(F.array(
        F.aggregate(h, F.size(h).cast("long"), lambda a, x: (a * F.lit(BASE) + x) % F.lit(MODULUS))))
    return _let(word_hashes(text), lambda h: F.when(F.size(h) < gram, short(h)).otherwise(_doubled(h, gram, roll)))


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The chosen k-grams as packed longs, in order of position."""
    packed = F.transform(gram_hashes(text, gram), lambda g, i: g * F.lit(POSITIONS) + (F.lit(POSITIONS - 1) - i))
    least = lambda p, q, _: F.least(p, q)
    return _let(packed, lambda g: F.when(F.size(g) == 0, g).when(F.size(g) < window, F.array(F.array_min(g)))
                .otherwise(F.array_distinct(_doubled(g, window, least))))


def chosen_hashes(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, 31)))


def as_text(fingerprint: Column) -> Column:
    """hash@position of each chosen k-gram, in hex and decimal."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, 31))), F.lit("@"),
        (F.lit(POSITIONS - 1) - x % F.lit(POSITIONS)).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two sets of chosen hashes."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` and ``fingerprint`` (array of hash, position); a column of that name is replaced."""
    return docs.withColumn("fingerprint", F.transform(winnow(F.col("text"), gram, window), lambda x: F.struct(
        F.shiftright(x, 31).alias("hash"), (F.lit(POSITIONS - 1) - x % F.lit(POSITIONS)).alias("position"))))


def _ranges(docs: DataFrame, parts: int) -> Column:
    """Number of the id range of column ``k``, larger ids first, by approximate quantiles.

    The bounds are looked up in two steps, so a row costs the root of their number.
    """
    if parts < 2:
        return F.lit(0)
    at = [i / parts for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx("k", at, max(10_000, 10 * parts)).alias("q")).first().q
    bounds = sorted(set(bounds or []))
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    tails = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups])
    below = lambda a: F.size(F.filter(a, lambda x: x < F.col("k")))
    group = below(heads)
    number = F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + below(F.element_at(tails, F.greatest(group, F.lit(1)))))
    return F.lit(len(bounds)) - number


def with_next(docs: DataFrame) -> tuple[DataFrame, object]:
    """doc_id, text, the next document's text in descending order of ids, and the window it was taken in.

    Ids are cut into ranges that one task orders; the first row of a range is
    copied to the range before it (the first of all to the last), flagged
    ``guest``.  Null ids come last, equal ids in order of their texts.
    """
    parts = parts_for(text_bytes(docs), RANGE_BYTES)
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("k"))
    base = base.withColumn("part", _ranges(base.select("k"), parts))
    tops = checked_side(base.groupBy("part").agg(F.max("k").alias("top")))
    # one row per range from here: a window over them all is small
    ring = Window.orderBy("part")
    last = tops.agg(F.max("part")).first()[0]
    goes = checked_side(tops.select("top", F.coalesce(F.lag("part").over(ring), F.lit(last)).alias("to")))
    heads = base.join(goes, base["k"] == goes["top"]).groupBy("k", "to").agg(F.min("text").alias("text"))
    guests = heads.select(F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"), "text", "k", F.col("to").alias("part"), F.lit(True).alias("guest"))
    rows = base.withColumn("guest", F.lit(False)).unionByName(guests)
    order = Window.partitionBy("part").orderBy("guest", F.col("k").desc(), "text")
    return rows.withColumn("next_text", F.lead("text").over(order)), order


def compare_with_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by as
    many first ones of the next document (or all it has).
    """
    rows, order = with_next(docs)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)))
    rows = rows.withColumn("fp", winnow(F.col("text"), gram, window)).withColumn("efp", winnow(F.col("edited"), gram, window))
    rows = rows.withColumn("own", chosen_hashes(F.col("fp")))
    rows = rows.withColumn("next", F.lead("own").over(order)).where(~F.col("guest"))
    return rows.select(
        "doc_id", "n_chars", F.col("edited").alias("edited_text"), as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("own"), chosen_hashes(F.col("efp"))).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"))
