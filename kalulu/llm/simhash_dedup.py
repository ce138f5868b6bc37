"""SimHash near-duplicates by a segment-popcount grid (operator 3).

A text's fingerprint holds a bit where more than half of its word shingles'
hashes hold it.  The 64 bits are embedded as 16 counts, one per segment of four
bits.  Flipping a bit moves one count by one, so the Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints: a pair
within two bits has embeddings within two steps, and some grid point lies
within one step of both.  The range join is an equi-join on that point: each
distinct fingerprint goes to its own grid point and the 32 around it.

* Points with at most ``SMALL`` fingerprints verify their pairs exactly.
* Fuller points (groups of near copies) are split by the same midpoint idea on
  the bits themselves: each fingerprint goes to the 65 values within one bit;
  all at such a value (65 at most) are within two bits of each other, and each
  is tied to the smallest.  Two fingerprints within two bits of each other
  always share such a value, so no link is lost and no group is expanded.

Components follow from the links.  Nulls: a null text is empty; a text without
words has fingerprint zero and links like any other; a null doc_id stays a row
and is never the smallest id unless its component has no other.  Repeated rows
stay rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu.llm.components import connected_components

SEED = 42
SEGMENTS, SEGMENT_BITS = 16, 4
SMALL = 32


def _fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo:lo + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        for j in range(8):   # bits of byte j, by the counts of its values
            ones[8 * j:8 * j + 8] += np.bincount(part[:, j], minlength=256) @ _BITS
    bits = 2 * ones > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big", signed=True)


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3, *more: Column) -> DataFrame:
    """doc_id, the fingerprint ``fp`` as a long, and ``key`` (a struct of ``more``, if given), for each row."""
    keyed = bool(more)

    def run(batches):
        for batch in batches:
            texts = (x.as_py() for x in batch.column(1).cast(pa.binary()))     # one text at a time
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "fp": pa.array([_fingerprint(t or b"", shingle) for t in texts], pa.int64()),
                **({"key": batch.column(2)} if keyed else {}),
            })
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *([F.struct(*more).alias("key")] if keyed else []))
    key = f", key {rows.schema['key'].dataType.simpleString()}" if keyed else ""
    return rows.mapInArrow(run, f"doc_id bigint, fp bigint{key}")


def _embedding(fp: Column) -> list[Column]:
    mask = (1 << SEGMENT_BITS) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, SEGMENT_BITS * i).bitwiseAND(F.lit(mask).cast("long"))) for i in range(SEGMENTS)]


def _grid_points(fp: Column) -> Column:
    """The embedding's grid point and its neighbours one step away, each packed in a long (3 bits a count)."""
    counts = _embedding(fp)
    point = sum((F.shiftleft(c.cast("long"), 3 * i) for i, c in enumerate(counts)), F.lit(0).cast("long"))
    steps = [F.when(c < SEGMENT_BITS, point + F.lit(1 << 3 * i).cast("long")) for i, c in enumerate(counts)]
    steps += [F.when(c > 0, point - F.lit(1 << 3 * i).cast("long")) for i, c in enumerate(counts)]
    return F.filter(F.array(point, *steps), lambda x: x.isNotNull())


def _bit_midpoints(fp: Column) -> Column:
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    return F.transform(flips, lambda x: x.bitwiseXOR(fp))


def fingerprint_links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp``: enough to connect all within ``max_bits`` <= 2."""
    if max_bits > 2:
        raise ValueError("the grid covers up to two differing bits")
    # each fingerprint becomes 33 rows: spread them first, adaptive coalescing looks at the bytes before
    width = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = prints.repartition(width, F.xxhash64("fp")).select("fp", F.explode(_grid_points(F.col("fp"))).alias("point"))
    # points that hold two or more; their fullness decides how they are verified
    full = at.groupBy("point").agg(F.count("*").alias("n")).where("n > 1")
    at = at.join(full, "point")
    few = at.where(F.col("n") <= SMALL).groupBy("point").agg(F.collect_list("fp").alias("fps"))
    pairs = few.select(F.explode(F.flatten(F.transform(
        "fps", lambda x: F.transform(F.filter("fps", lambda y: (y > x) & (F.bit_count(x.bitwiseXOR(y)) <= max_bits)),
                                     lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).select("p.a", "p.b")
    many = at.where(F.col("n") > SMALL).select("fp").distinct()
    near = many.select("fp", F.explode(_bit_midpoints(F.col("fp"))).alias("mid"))
    if max_bits == 2:
        star = near.groupBy("mid").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    else:   # one bit apart or equal: the midpoint itself is one of the two
        star = near.groupBy("mid").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        star = star.where(F.array_contains("fps", F.col("mid"))).withColumn("a", F.col("mid"))
        if max_bits == 0:
            star = star.where(F.lit(False))
    star = star.select("a", F.explode("fps").alias("b")).where("a <> b")
    return pairs.unionByName(star)


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fp (long), fingerprint (16 hex digits), component_id for each row."""
    prints = fingerprints(docs, shingle)
    return components_of(prints, max_bits)


def components_of(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    from kalulu.llm.common import checkpoint

    prints = checkpoint(prints)
    classes = _tied(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), max_bits)
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _tied(classes: DataFrame, max_bits: int) -> DataFrame:
    """fp, least, component of the distinct fingerprints ``fp``."""
    tied = connected_components(fingerprint_links(classes.select("fp"), max_bits))
    return classes.join(tied.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` of each component: that of the smallest doc_id.

    Null ids come last; of several rows of that id the one of the smallest
    hashes of text and row stays, and rows that are equal throughout count once.
    """
    from kalulu.llm.common import NULL_ID, checkpoint

    id_ = F.col("doc_id").cast("long")
    key = [id_.isNull().alias("none"), F.coalesce(id_, F.lit(NULL_ID)).alias("id"), F.xxhash64(F.col("text")).alias("text_hash"),
           F.xxhash64(F.lit("row"), *[F.col(f"`{c}`") for c in docs.columns]).alias("row_hash")]
    prints = checkpoint(fingerprints(docs, shingle, *key).groupBy("fp", "key").agg(F.count("*").alias("n")))
    classes = _tied(prints.groupBy("fp").agg(F.min(F.struct("key", "n")).alias("least")), max_bits)
    keep = classes.groupBy("component").agg(F.min("least").alias("kept")).select("kept.key.*", "kept.n")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key)
    rows = rows.join(keep, ["none", "id", "text_hash", "row_hash"])
    # equal rows: counted under another key than the join's, so that adaptive execution may split a hot one there
    equal = rows.where("n > 1").groupBy(F.xxhash64("none", "id", "text_hash", "row_hash"), "row_hash").agg(F.first("row").alias("row"))
    return rows.where("n = 1").select("row.*").unionByName(equal.select("row.*"))
