"""Benchmark decontamination by BM25 with block-max WAND (operator 5).

The inverted index is of the test items; every passage of every document is a
query against it.  Scores are BM25 impacts of an item's terms found in the
passage, divided by the item's own total, so 1 means that the passage holds all
of the item.  All (passage, item) pairs at or above the threshold are
retrieved, and each is verified: the share of the item's question and of its
answer, in ``SHINGLE``-word shingles, that the passage holds.

WAND's pivot is taken over whole passages: terms are ordered by their largest
impact, and those that together cannot lift any item to the threshold are
skipped at first; a passage without any other term has no item above it.  For
the rest the items are kept in blocks, and the sum of the terms' block maxima
bounds each block; only blocks whose bound reaches the threshold are scored.

Items are split into shards of bounded size and of like length (up to 64, 128,
256, ... words; passages have twice as many words and half overlap, so that
every item lies whole in some passage); one shard's index is broadcast at a time and meets all
documents.  The item's answer is its last sentence (the last third of its words
if it has only one), the question the words before it.

Words are lower-cased (A-Z) runs of bytes without ASCII blanks and punctuation.
Nulls: a null text has no passages; items without words are not indexed; a null
doc_id or item_id stays null.  Items of equal text are retrieved each.
Repeated rows are matched each.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.llm.common import NULL_ID, checked_side, parts_for

K1, B = 1.2, 0.75
THRESHOLD = 0.6            # of the item's own score
SHINGLE, OVERLAP = 5, 0.8
INDEX_BYTES = 4 << 20      # text of the items in one shard of the index
BLOCK_ITEMS = 8
POSTINGS = 1 << 20         # postings looked at together

_PUNCT = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_FOLD = bytes.maketrans(_PUNCT, b" " * len(_PUNCT))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).lower().split()


def question_and_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    parts = [w for w in map(words_of, re.split(r"[.?!\n]+", text or "")) if w]
    if not parts:
        return [], []
    words = [w for p in parts for w in p]
    cut = len(words) - len(parts[-1]) if len(parts) > 1 else len(words) - math.ceil(len(words) / 3)
    return words[:cut], words[cut:]


def _shingles(words: list[bytes]) -> set[tuple]:
    n = min(SHINGLE, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


class Index:
    """Impacts of a shard of items; everything is bounded by INDEX_BYTES of text."""

    def __init__(self, items: list[tuple], df: dict[bytes, int], n_items: int, mean_len: float, window: int, threshold: float):
        items = [(i, words_of(t), *question_and_answer(t)) for i, t in items]
        items = sorted((x for x in items if x[1]), key=lambda x: (sorted(x[1]), str(x[0])))   # like items share blocks
        self.ids = [x[0] for x in items]
        self.threshold = threshold
        self.checks = [(_shingles(q), _shingles(a), len(q), len(a)) for _, _, q, a in items]
        self.window = window
        self.impacts: list[dict[bytes, float]] = []
        for _, words, _, _ in items:
            norm = K1 * (1 - B + B * len(words) / mean_len)
            w = {t: math.log1p((n_items - df[t] + .5) / (df[t] + .5)) * n * (K1 + 1) / (n + norm) for t, n in Counter(words).items()}
            total = sum(w.values())
            self.impacts.append({t: x / total for t, x in w.items()})
        top: dict[bytes, float] = {}
        for item in self.impacts:
            for t, x in item.items():
                top[t] = max(top.get(t, 0), x)
        # skipped terms: the most, from the smallest impact up, that leave every item below the threshold
        held, by_term = [0.0] * len(items), {}
        for i, item in enumerate(self.impacts):
            for t in item:
                by_term.setdefault(t, []).append(i)
        skipped = set()
        for t in sorted(top, key=lambda t: (-len(by_term[t]), top[t], t)):
            if any(held[i] + self.impacts[i][t] >= 0.5 * threshold for i in by_term[t]):
                continue
            for i in by_term[t]:
                held[i] += self.impacts[i][t]
            skipped.add(t)
        terms = sorted(t for t in top if t not in skipped)
        self.number = {t: n for n, t in enumerate(terms)}
        self.blocks = max(1, math.ceil(len(items) / BLOCK_ITEMS))
        self.rest = np.zeros(self.blocks)                      # what skipped terms can add
        postings: list[dict[int, float]] = [{} for _ in terms]  # block -> largest impact of the term there
        for i, item in enumerate(self.impacts):
            block = i // BLOCK_ITEMS
            self.rest[block] = max(self.rest[block], held[i])
            for t, x in item.items():
                if t in self.number:
                    post = postings[self.number[t]]
                    post[block] = max(post.get(block, 0), x)
        self.at = np.cumsum([0, *map(len, postings)])
        self.post_block = np.array([k for p in postings for k in p], np.int64)
        self.post_max = np.array([x for p in postings for x in p.values()])

    def search(self, words: list[bytes]) -> list[tuple]:
        """(item number, passage start, passage words, score) of all pairs at or above the threshold."""
        n, half = len(words), self.window // 2
        ids = np.fromiter(map(self.number.get, words, _MISSING), np.int32, n)
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return []
        last = max(0, math.ceil((n - self.window) / half))      # passages start at 0, half, 2 half, ...
        term, p = ids[at].astype(np.int64), at // half
        both = np.concatenate((np.minimum(p, last), p - 1)) * len(self.number) + np.concatenate((term, term))
        pairs = np.unique(both[both >= 0])
        passage, term = pairs // len(self.number), pairs % len(self.number)
        size = self.at[term + 1] - self.at[term]
        found = []
        for p, block in zip(*self._reached(passage, term, size)):
            start = p * half
            stop = n if p == last else start + self.window
            held = set(words[start:stop])
            for i in range(block * BLOCK_ITEMS, min(len(self.ids), (block + 1) * BLOCK_ITEMS)):
                score = sum(w for t, w in self.impacts[i].items() if t in held)
                if score >= self.threshold:
                    found.append((i, start, stop - start, score))
        return found

    def _reached(self, passage: np.ndarray, term: np.ndarray, size: np.ndarray) -> tuple[list, list]:
        """Passages and the blocks whose bound reaches the threshold."""
        out = ([], [])
        head = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        before = np.r_[0, np.cumsum(size)]
        lo = 0
        while lo < len(passage):                                # whole passages, so many postings at a time
            after = head[np.searchsorted(before[head], before[lo] + POSTINGS, "right"):]
            hi = next((int(x) for x in after if x > lo), len(passage))
            n = size[lo:hi]
            post = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.at[term[lo:hi]], n)
            key = np.repeat(passage[lo:hi], n) * self.blocks + self.post_block[post]
            key, inverse = np.unique(key, return_inverse=True)
            bound = np.bincount(inverse, self.post_max[post], len(key)) + self.rest[key % self.blocks]
            key = key[bound >= self.threshold - 1e-9]
            out[0].extend((key // self.blocks).tolist())
            out[1].extend((key % self.blocks).tolist())
            lo = hi
        return out

    def verify(self, words: list[bytes], hit: tuple) -> tuple[float, float]:
        i, start, size, _ = hit
        q, a, nq, na = self.checks[i]
        passage = words[start:start + size]
        have = {}
        for n in {min(SHINGLE, nq), min(SHINGLE, na)} - {0}:
            have[n] = set(zip(*(passage[j:] for j in range(n))))
        share = lambda s, n: len(s & have[min(SHINGLE, n)]) / len(s) if s else 1.0
        return share(q, nq), share(a, na)


class _Missing:
    """-1 for ever: the default of dict.get in a map."""

    def __iter__(self):
        return self

    def __next__(self):
        return -1


_MISSING = _Missing()


def _term_counts(batches):
    for batch in batches:
        rows = [(t, n) for x in batch.column(0).to_pylist() for t, n in Counter(words_of(x)).items()]
        yield pa.record_batch({"term": pa.array([t for t, _ in rows], pa.binary()), "n": pa.array([n for _, n in rows], pa.int64())})


def _item_lengths(batches):
    for batch in batches:
        yield pa.record_batch({"item_id": batch.column(0), "text": batch.column(1), "n": pa.array([len(words_of(x)) for x in batch.column(1).to_pylist()], pa.int64())})


def index_shards(benchmark: DataFrame, threshold: float = THRESHOLD):
    """The index, a bounded shard at a time.  Items of 2^(k-1)+1 to 2^k words go to shards of class k (k >= 6)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _item_lengths, "item_id bigint, text string, n bigint").where("n > 0")
    terms = items.select("text").mapInArrow(_term_counts, "term binary, n bigint")
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    length = F.greatest(F.lit(6), F.ceil(F.log2("n")).cast("int"))
    classes = items.groupBy(length.alias("k")).agg(
        F.count("*").alias("items"), F.sum("n").alias("words"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).orderBy("k").collect()
    n_items, n_words = sum(r["items"] for r in classes), sum(r["words"] for r in classes)
    for r in classes:                                   # at most 31 - 5 classes of length
        parts = parts_for(r["bytes"], INDEX_BYTES)
        for part in range(parts):
            mine = items.where((length == r["k"]) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)).select("item_id", "text")
            rows = [(x.item_id, x.text) for x in mine.collect()]
            held = df.join(mine.select("text").mapInArrow(_term_counts, "term binary, n bigint").select("term").distinct(), "term", "left_semi")
            counts = {bytes(x.term): x.df for x in held.collect()}
            yield Index(rows, counts, n_items, n_words / n_items, 2 << r["k"], threshold)


_HITS = "doc_id bigint, item_id bigint, passage_start bigint, passage_words bigint, score double, question_overlap double, answer_overlap double"


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """A row per document row and item found in it (its best passage): question and answer both at or above ``overlap``."""
    return _found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                  benchmark, threshold, overlap, _HITS)


def _found(texts: DataFrame, benchmark: DataFrame, threshold: float, overlap: float, schema: str) -> DataFrame:
    """Hits in ``texts`` (a key and a text); their first column is the key, of the type that ``schema`` names."""
    spark = texts.sparkSession
    out = spark.createDataFrame([], schema)
    for index in index_shards(benchmark, threshold):
        shared = spark.sparkContext.broadcast(index)    # INDEX_BYTES of text at most

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                rows = []
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    words = words_of(text.as_py())
                    best: dict[int, tuple] = {}
                    for hit in index.search(words):
                        q, a = index.verify(words, hit)
                        if q >= overlap and a >= overlap:
                            i, start, size, score = hit
                            rank = (q + a, score, -start)
                            if i not in best or rank > best[i][0]:
                                best[i] = (rank, (key, index.ids[i], start, size, score, q, a))
                    rows += [best[i][1] for i in sorted(best)]
                cols = list(zip(*rows)) or [()] * 7
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, [batch.schema.field(0).type] + [pa.int64()] * 3 + [pa.float64()] * 3)],
                                      names=[x.split()[0] for x in schema.split(", ")])
        out = out.unionByName(texts.mapInArrow(run, schema))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` whose own text holds no benchmark item.

    Each row is judged by its text: other rows of its doc_id, null or not, stay.
    """
    id_ = lambda d: F.coalesce(d["doc_id"].cast("long"), F.lit(NULL_ID))
    digest = lambda d: F.sha2(d["text"].cast("string").cast("binary"), 256)
    keyed = docs.select(F.struct(id_(docs).alias("id"), digest(docs).alias("digest")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    bad = _found(keyed, benchmark, threshold, overlap, _HITS.replace("bigint", "struct<id:bigint,digest:string>", 1))
    bad = checked_side(bad.select(F.col("doc_id.id").alias("_bad"), F.col("doc_id.digest").alias("_bad_digest")).distinct())
    return docs.join(bad, (id_(docs) == bad["_bad"]) & (digest(docs) == bad["_bad_digest"]), "left_anti")
