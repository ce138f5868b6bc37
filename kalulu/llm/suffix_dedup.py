"""Suffix-array de-duplication by longest-previous-factor arrays (operator 10).

Texts are UTF-8 bytes.  A byte goes if it lies in a string of ``length`` bytes
that also starts earlier (smaller doc_id, or the same document at an earlier
byte); the first copy stays.  ``kalulu.llm.repeats`` routes the windows that
occur more than once to shards by content; each shard sorts the suffixes of its
pieces (prefix doubling up to ``length``), and the previous and next smaller
positions in suffix order give every position's longest previous factor.

Nulls: a null text is empty, a null doc_id comes first.  Texts shorter than
``length`` stay whole.  Rows equal in doc_id and text are one document (each
row gets its result); rows that share only the doc_id are ordered by the hash
of their text.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.llm.repeats import Spec, remove_repeats

GRAM_BYTES = 32


def _ranks(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of all positions by their first 8, 16, 32, ... bytes (< length)."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | padded[j:n + j].astype(np.uint64)
    out = []
    width = 8
    while True:
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        out.append((width, rank))
        if 2 * width > length:
            return out
        key = rank * np.int64(n + 1)
        key[:n - width] += rank[width:] + 1
        width *= 2


def longest_previous_factor(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each start (ascending), how much of its next ``length`` bytes also begins at an earlier start.

    Counts in steps of eight bytes, and ``length`` where all of it does.  Every
    start needs ``length`` bytes after it.
    """
    levels = _ranks(data, length)
    width, rank = levels[-1]
    # two overlapping stretches of ``width`` bytes cover the first ``length``
    key = rank[starts] * np.int64(len(data) + 1) + rank[starts + length - width]
    suffix = np.argsort(key, kind="stable")
    a, b = starts[suffix[:-1]], starts[suffix[1:]]
    common = np.zeros(len(a), np.int64)
    for w, r in reversed(levels):
        fits = common + w <= length
        i, j = np.where(fits, a + common, a), np.where(fits, b + common, b)
        common += w * (fits & (r[i] == r[j]))
    common[key[suffix[:-1]] == key[suffix[1:]]] = length
    best = np.maximum(_reach(suffix, common), _reach(suffix[::-1], common[::-1])[::-1])
    out = np.empty(len(starts), np.int64)
    out[suffix] = best
    return out


def _reach(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Common prefix of each entry with the nearest entry before it that has a smaller position.

    Pointer jumping: all entries between an entry and its pointer have larger
    positions, so a pointer to a larger position may skip to that one's own.
    """
    n = len(order)
    to = np.arange(-1, n - 1)
    low = np.concatenate(([0], common))
    live = np.flatnonzero((to >= 0) & (low > 0))
    low[0] = 0
    while len(live):
        p = to[live]
        live = live[order[p] > order[live]]
        if not len(live):
            break
        p = to[live]
        low[live] = np.minimum(low[live], low[p])
        to[live] = to[p]
        live = live[(to[live] >= 0) & (low[live] > 0)]
    low[to < 0] = 0
    return low


def lpf_matcher(length: int):
    def match(pieces: list, places: list, keys: list) -> list:
        order = sorted(range(len(pieces)), key=lambda i: places[i])
        data = np.frombuffer(b"".join(pieces[i] for i in order), np.uint8)
        sizes = np.array([len(pieces[i]) for i in order], np.int64)
        ends = np.cumsum(sizes)
        windows = sizes - length + 1
        first = np.cumsum(windows) - windows
        starts = np.arange(int(windows.sum())) - np.repeat(first, windows) + np.repeat(ends - sizes, windows)
        seen = longest_previous_factor(data, starts, length) >= length
        out: list = [None] * len(pieces)
        for i, x, n in zip(order, first.tolist(), windows.tolist()):
            out[i] = seen[x:x + n]
        return out
    return match


def _cut(docs: DataFrame, length: int, characters: bool = False) -> DataFrame:
    spec = Spec("byte", length, min(GRAM_BYTES, max(1, length // 3)), within=True, characters=characters)
    return remove_repeats(docs, spec, lpf_matcher(length))


def suffix_dedup(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (byte ranges), kept (bytes) per row."""
    return _cut(docs, length).select(
        F.col("rest.doc_id").cast("long").alias("doc_id"), F.col("n_units").alias("n_bytes"), "n_removed", "spans", "kept")


def suffix_dedup_texts(docs: DataFrame, length: int = 100) -> DataFrame:
    """The rows of ``docs`` with later copies cut out of ``text`` (``n_chars``, if there, counts anew).

    Bytes of a character of which only a part was cut are dropped.  A null text
    comes back empty.
    """
    cut = _cut(docs, length, characters=True).withColumn("text", F.col("kept").cast("string"))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("text"))
        elif c == "n_chars":
            out.append(F.length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"rest.`{c}`").alias(c))
    return cut.select(*out)
