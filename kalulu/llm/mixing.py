"""Mixing sources to target weights by Poisson replication (operator 7).

The mean repetition rate of a source is its target share of the documents over
its present share, times ``size``.  Each document draws its number of copies
from a Poisson distribution of that mean by inverting the distribution function
at a number hashed from the seed and its id, is exploded by that count, and
the copies are shuffled globally by a hashed key: rows go to partitions by the
key and a salt of the row (rows of one id have one key) and are sorted by the key
inside, so partitions read in turn are in random order.

Rates above ``DRAW_RATE`` are split into several independent draws of equal
mean (their sum has the same distribution), so arrays stay short whatever the
rate.  A hot source needs no shuffle of its own: rates join by a counted
broadcast, or by a join that adaptive execution splits.

Without weights, targets follow ``share ** temperature``.  Sources without a
given weight have weight 0.  A null source is a source of its own; a null
doc_id hashes as the empty text; rows of one doc_id draw the same count; empty
texts are documents.  Input columns named ``copy`` or ``shuffle_key`` are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu.llm.common import checked_side

SEED = "mix-1"
TEMPERATURE = 0.7
DRAW_RATE = 16.0


def _hashed(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def _uniform(digest: Column) -> Column:
    """52 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def repetition_rates(docs: DataFrame, weights: dict | None = None, temperature: float = TEMPERATURE, size: float = 1.0) -> DataFrame:
    """source, n_docs, rate: one row per source."""
    n = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(float(temperature)))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        weight = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(0.0)
    n = n.withColumn("weight", weight)
    all_weight, all_docs = n.agg(F.sum("weight"), F.sum("n_docs")).first()
    if not all_weight:
        return n.select("source", "n_docs", F.lit(0.0).alias("rate"))
    rate = F.col("weight") / F.lit(all_weight) * F.lit(all_docs) / F.col("n_docs") * F.lit(float(size))
    return n.select("source", "n_docs", rate.alias("rate"))


def _with_distribution(rates: DataFrame) -> DataFrame:
    """draws, and the distribution function of one draw up to a tail below 2^-60."""
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / DRAW_RATE)).cast("int")
    mean = F.col("rate") / F.col("draws")
    last = F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 30).cast("int")
    step = F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf"))
    cdf = F.aggregate(F.sequence(F.lit(1), last), step, lambda a, k: F.struct(
        (a["p"] * F.col("mean") / k).alias("p"),
        F.array_append(a["cdf"], F.element_at(a["cdf"], -1) + a["p"] * F.col("mean") / k).alias("cdf")))["cdf"]
    return rates.withColumn("draws", draws).withColumn("mean", mean).select(F.col("source").alias("_source"), F.struct("draws", cdf.alias("cdf")).alias("_rate"))


def mix(docs: DataFrame, weights: dict | None = None, temperature: float = TEMPERATURE, size: float = 1.0, seed: str = SEED) -> DataFrame:
    """The columns of ``docs``, ``copy`` (0, 1, ...) and ``shuffle_key``, in shuffled order."""
    rates = checked_side(_with_distribution(repetition_rates(docs, weights, temperature, size)))
    docs = docs.drop("copy", "shuffle_key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")     # no name of a document can clash
    salt = F.xxhash64(F.spark_partition_id(), row).alias("salt")              # rows of one id share a key: spread them
    rows = docs.select(row, F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("source").cast("string").alias("source"), salt)
    rows = rows.join(rates, F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("draw", F.explode(F.sequence(F.lit(0), F.col("_rate.draws") - 1)))
    rows = rows.withColumn("u", _uniform(_hashed(F.lit(seed), F.col("id"), F.col("draw").cast("string"))))
    rows = rows.withColumn("n", F.size(F.filter("_rate.cdf", lambda c: c <= F.col("u")))).where("n > 0")
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    key = F.substring(_hashed(F.lit(seed), F.col("id"), F.col("draw").cast("string"), F.col("k").cast("string"), F.lit("key")), 1, 16)
    rows = rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns],
                       (F.col("draw").cast("long") * 1_000_000 + F.col("k")).alias("copy"), key.alias("shuffle_key"), "salt")
    rows = rows.repartition("shuffle_key", "salt")
    return rows.select(*[c for c in rows.columns[:-1]]).sortWithinPartitions("shuffle_key")


def mix_sql(table: str = "documents", columns: str = "d.doc_id, d.text, d.lang, d.source, d.n_chars", temperature: float = TEMPERATURE, seed: str = SEED) -> str:
    """The same rows in DuckDB SQL."""
    unit = "('0x' || substr(md5(concat_ws(':', {})), 1, 13))::BIGINT / 4503599627370496.0"
    u = unit.format(f"'{seed}', coalesce(d.doc_id::VARCHAR, ''), r.draw::VARCHAR")
    return f"""
WITH per_source AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {temperature}) AS w FROM {table} GROUP BY source),
rates AS (SELECT source, w / (SELECT sum(w) FROM per_source) * (SELECT sum(n) FROM per_source) / n AS rate FROM per_source),
draws AS (SELECT source, rate, greatest(1, ceil(rate / {DRAW_RATE}))::BIGINT AS m FROM rates),
terms AS (SELECT source, m, rate / m AS mean, unnest(range(0, ceil(rate / m + 12 * sqrt(rate / m) + 30)::BIGINT + 1)) AS k FROM draws),
masses AS (SELECT source, m, k, exp(k * ln(mean) - mean - lgamma(k + 1)) AS p FROM terms),
cdfs AS (SELECT source, m, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM masses),
per_draw AS (SELECT source, list(c ORDER BY k) AS cdf, unnest(range(0, any_value(m))) AS draw FROM cdfs GROUP BY source),
counted AS (SELECT d.*, r.draw, len(list_filter(r.cdf, lambda x: x <= {u})) AS n_copies
            FROM {table} d JOIN per_draw r ON d.source IS NOT DISTINCT FROM r.source),
copies AS (SELECT *, unnest(range(0, n_copies)) AS k FROM counted)
SELECT {columns}, d.draw * 1000000 + d.k AS copy,
       substr(md5(concat_ws(':', '{seed}', coalesce(d.doc_id::VARCHAR, ''), d.draw::VARCHAR, d.k::VARCHAR, 'key')), 1, 16) AS shuffle_key
FROM copies d"""
