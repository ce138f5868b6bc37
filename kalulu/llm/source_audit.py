"""Source divergence audit by one-hot level products (operator 12).

How far do the sources of a language differ in their words?  Terms are runs of
letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, only A-Z lower-cased); a
language keeps those in at least ``min_docs`` of its documents.  A group (lang,
source) gives each kept term the smoothed share p = 1 + floor(10^9 (count + 2)
/ (N + 2 V)), and two shares differ by f = floor((p - q)^2 / (p + q)).

The sum of f over all terms depends only on how many terms have which pair of
counts.  Each group gets an indicator column for each of its count levels (zero
included); the columns times their transpose give, in one exact product, the
joint table of the levels of every two groups.  The product is taken over
blocks of terms: terms of about equal totals share a block, so that it has few
levels, and a block is halved until its columns fit ``MAX_COLUMNS``.  Every
cell of a joint table is priced once by f, however many terms it counts.  All
arithmetic is on integers.

Nulls: null text, lang and source are ''.  Repeated rows are documents of their
own.  A group without terms is one with N = 0; a language without kept terms
gives 0 for each pair.  Ties rank by the item's UTF-8 bytes.  An empty table
gives no rows.  Other columns are not read.  A task holds the terms of one
block and one document; a term's counts by source are one row, as long as the
number of sources, whose square the result has by definition.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalulu.llm.common import checked_side, checkpoint

UNIT = 1_000_000_000
MAX_COLUMNS = 2_048       # indicator columns of one product
BLOCK_CELLS = 1 << 16     # terms x groups of one block
FLUSH_TERMS = 250_000     # distinct (group, term) that a task holds before it writes them out
PIECE = 1 << 22           # bytes of a text that are split at once

# lower-cases A-Z, keeps a-z and every byte of a non-ASCII character, makes all else a space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _pieces(raw: bytes):
    """A folded text in pieces cut at a space."""
    lo = 0
    while len(raw) - lo > PIECE:
        hi = raw.rfind(b" ", lo, lo + PIECE)
        hi = hi if hi > lo else raw.find(b" ", lo + PIECE)
        if hi < 0:
            break
        yield raw[lo:hi]
        lo = hi
    yield raw[lo:] if lo else raw


def _count(batches):
    """lang, source, term, n, docs: occurrences and documents, summed over a stretch of a task's rows."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def out():
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            k = len(terms)
            yield pa.record_batch({
                "lang": pa.array([lang] * k, pa.string()), "source": pa.array([source] * k, pa.string()),
                "term": pa.array(terms, pa.binary()).cast(pa.string()),
                "n": pa.array(n.values(), pa.int64()), "docs": pa.array([docs[x] for x in terms], pa.int64())})
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            keys = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
            for key, text in zip(keys, part.column(2)):
                n, docs = held.setdefault(key, (Counter(), Counter()))
                seen: set[bytes] = set()
                for piece in _pieces(text.as_py().translate(_FOLD)):
                    words = piece.split()
                    n.update(words)
                    seen.update(words)
                docs.update(seen)
            if sum(len(n) for n, _ in held.values()) > FLUSH_TERMS:
                yield from out()
    yield from out()


def kept_terms(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """lang, term, total, counts (array of source, n): the terms in at least ``min_docs`` documents of a language.

    Tasks add up their own rows first, so a hot source or word is a row or two a
    task; one shuffle by (lang, term) serves both groupings.
    """
    rows = _named(docs).select("lang", "source", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    counts = rows.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint").repartition("lang", "term")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return terms.where(F.col("docs") >= min_docs).drop("docs")


def _named(docs: DataFrame) -> DataFrame:
    fill = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(fill("lang").alias("lang"), fill("source").alias("source"), F.col("text"))


def group_totals(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source, n, v, lang_n: each occurring group, its kept occurrences, its language's kept terms and occurrences."""
    cells = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    return _named(docs).select("lang", "source").distinct().join(cells, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), exact at any size."""
    return F.expr(f"1 + ({UNIT} * (cast({count} as decimal(20,0)) + 2)) div (cast({total} as decimal(20,0)) + 2 * {terms})")


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same over an array of counts of one group."""
    least = total + 2 * terms
    if len(counts) and int(counts.max()) + 2 >= (1 << 63) // UNIT:
        return np.array([1 + UNIT * (int(c) + 2) // least for c in counts], np.int64)
    return 1 + UNIT * (counts.astype(np.int64) + 2) // least


def joint_tables(counts: np.ndarray):
    """The joint tables of count levels of every two columns of ``counts`` (terms x groups).

    Yields arrays (group a, level a, group b, level b, number of terms), a < b,
    whose cells add up over what is yielded.
    """
    stack = [counts]
    while stack:
        part = stack.pop()
        if not len(part):
            continue
        levels, column = [], np.empty(part.shape, np.int64)
        first = 0
        for g in range(part.shape[1]):
            found, place = np.unique(part[:, g], return_inverse=True)
            column[:, g] = first + place.reshape(-1)
            levels.append(found)
            first += len(found)
        if first > MAX_COLUMNS and len(part) > 1:
            stack += [part[: len(part) // 2], part[len(part) // 2:]]
            continue
        group = np.repeat(np.arange(len(levels)), [len(x) for x in levels])
        level = np.concatenate(levels) if levels else np.zeros(0, np.int64)
        hot = np.zeros((len(part), first), np.float32)      # counts of far fewer than 2^24 terms: exact
        hot[np.arange(len(part))[:, None], column] = 1
        for lo in range(0, first, MAX_COLUMNS):
            for lo2 in range(lo, first, MAX_COLUMNS):
                product = hot[:, lo:lo + MAX_COLUMNS].T @ hot[:, lo2:lo2 + MAX_COLUMNS]
                i, j = np.nonzero(product)
                n = product[i, j].astype(np.int64)
                i, j = i + lo, j + lo2
                up = group[i] < group[j]
                i, j, n = i[up], j[up], n[up]
                yield group[i], level[i], group[j], level[j], n


def price_block(counts: np.ndarray, totals: list[int], terms: int) -> np.ndarray:
    """groups x groups (upper half): f summed over the block's terms, priced by the cells of the joint tables."""
    out = np.zeros((len(totals), len(totals)), np.int64)
    for a, x, b, y, n in joint_tables(counts):
        p, q = np.empty(len(a), np.int64), np.empty(len(a), np.int64)
        for side, level, price in ((a, x, p), (b, y, q)):
            by = np.argsort(side, kind="stable")
            for one in np.split(by, np.flatnonzero(np.diff(side[by])) + 1):
                if len(one):
                    price[one] = shares(level[one], totals[side[one[0]]], terms)
        np.add.at(out, (a, b), n * ((p - q) * (p - q) // (p + q)))
    return out


def _price(key, left: pa.Table, right: pa.Table) -> pa.Table:
    lang = key[0].as_py()
    groups = sorted(zip(right.column("source").to_pylist(), right.column("n").to_pylist(), right.column("v").to_pylist()))
    place = {s: i for i, (s, _, _) in enumerate(groups)}
    block = left.sort_by("total").column("counts").combine_chunks()
    sizes = np.diff(block.offsets.to_numpy())
    cells = block.flatten()
    counts = np.zeros((len(sizes), len(groups)), np.int64)
    at = np.array([place[s] for s in cells.field("source").to_pylist()], np.int64)
    counts[np.repeat(np.arange(len(sizes)), sizes), at] = cells.field("n").to_numpy()
    values = price_block(counts, [n for _, n, _ in groups], groups[0][2] if groups else 0)
    a, b = np.triu_indices(len(groups), 1)
    names = [s for s, _, _ in groups]
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array([names[i] for i in a], pa.string()),
                     "b": pa.array([names[i] for i in b], pa.string()), "value": pa.array(values[a, b], pa.int64())})


def pair_divergence(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (a before b), value: summed over blocks of terms; pairs of languages with kept terms."""
    width = groups.groupBy("lang").agg(F.count("*").alias("width"))
    level = terms.withColumn("level", F.floor(F.log2("total")).cast("int"))
    blocks = level.groupBy("lang", "level").agg(F.count("*").alias("terms")).join(width, "lang")
    blocks = checked_side(blocks.select("lang", "level", F.ceil(F.col("terms") * F.col("width") / BLOCK_CELLS).alias("parts")))
    left = level.join(blocks, ["lang", "level"]).select(
        "lang", "level", F.pmod(F.xxhash64("term"), "parts").alias("part"), "total", "counts")
    right = blocks.select("lang", "level", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    right = right.join(groups.select("lang", "source", "n", "v"), "lang").select(
        *(F.col(c).alias(f"to_{c}") for c in ("lang", "level", "part")), "source", "n", "v")     # names of its own: both sides stem from ``terms``
    keys = ["lang", "level", "part"]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*(f"to_{c}" for c in keys))).applyInArrow(_price, "lang string, a string, b string, value bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def term_divergence(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: the terms that a group uses more than its language does."""
    cells = terms.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", F.col("c.source").alias("source"), "term", "total", F.col("c.n").alias("count"))
    cells = cells.join(checked_side(groups), ["lang", "source"]).where("count > 0")
    cells = cells.withColumn("p", share("count", "n", "v")).withColumn("q", share("total", "lang_n", "v")).where("p > q")
    return cells.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: divergence from each other source, and the ``top`` most telling terms."""
    terms = checkpoint(kept_terms(docs, min_docs))
    groups = checkpoint(group_totals(docs, terms))
    priced = pair_divergence(terms, groups)
    priced = priced.unionByName(priced.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    one, two = groups.select("lang", F.col("source").alias("a")), groups.select("lang", F.col("source").alias("b"))
    pairs = one.join(two, "lang").where("a <> b").join(priced, ["lang", "a", "b"], "left")    # the result's own rows
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    found = term_divergence(terms, groups).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    return pairs.withColumn("rank", rank).unionByName(found.withColumn("rank", rank).where(F.col("rank") <= top))


def audit_sql(min_docs: int = 10, top: int = 10) -> str:
    """The same in DuckDB SQL, cell by cell."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    p = f"cast(1 + ({UNIT}::hugeint * (k + 2)) // (n + 2 * v) as bigint)"
    return f"""
with d as (select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
w as (select rid, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[a-z\\x{{80}}-\\x{{10FFFF}}]+')) as term from d),
kept as (select lang, term, count(*) as total from w group by all having count(distinct rid) >= {min_docs}),
cells as (select w.lang, w.source, w.term, count(*) as k from w join kept using (lang, term) group by all),
langs as (select d.lang, (select count(*) from kept where kept.lang = d.lang) as v, (select coalesce(sum(total), 0) from kept where kept.lang = d.lang) as lang_n from (select distinct lang from d) d),
groups as (select g.lang, g.source, v, lang_n, (select coalesce(sum(k), 0) from cells c where c.lang = g.lang and c.source = g.source) as n
    from (select distinct lang, source from d) g join langs using (lang)),
full_cells as (select lang, source, term, k, total, n, v, lang_n, {p} as p, {p.replace("(k +", "(total +").replace("(n +", "(lang_n +")} as q
    from (select g.*, kept.term, kept.total, coalesce(c.k, 0) as k from groups g join kept on kept.lang = g.lang
          left join cells c on c.lang = g.lang and c.source = g.source and c.term = kept.term)),
priced as (select a.lang, a.source, b.source as item, sum(((a.p - b.p)::hugeint * (a.p - b.p)) // (a.p + b.p)) as value
    from full_cells a join full_cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(priced.value, 0) as bigint) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join priced on priced.lang = a.lang and priced.source = a.source and priced.item = b.source),
told as (select lang, source, 'term' as part, term as item, cast(((p - q)::hugeint * (p - q)) // (p + q) as bigint) as value from full_cells where k > 0 and p > q),
ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank from (select * from pairs union all select * from told))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {top}
"""
