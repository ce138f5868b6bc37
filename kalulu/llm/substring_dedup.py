"""Substring de-duplication by suffix automata of reference shards (operator 2).

A word goes if it lies in a window of ``words`` consecutive words whose sequence
also starts in a document with a smaller doc_id; windows are judged on the
input.  The reference of a document is every document before it, so it cannot
be broadcast: ``kalulu.llm.repeats`` routes the windows that occur more than
once to shards by content.  In a shard the pieces are streamed in doc_id order
through the suffix automaton of the pieces of smaller ids (matching
statistics); maximal spans at or above the length threshold are removed, and
the piece is then added to the automaton.

Nulls: a null text has no words, a null doc_id comes before all others and null
ids are equal.  Documents of one doc_id never remove each other's words.  Texts
of fewer than ``words`` words stay whole.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.llm.repeats import Spec, remove_repeats

GRAM_WORDS = 5


class SuffixAutomaton:
    """Generalised suffix automaton over hashable symbols."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]

    def _extend(self, last: int, symbol) -> int:
        nxt, link, size = self.next, self.link, self.size
        if symbol in nxt[last]:                      # known from an earlier sequence
            q = nxt[last][symbol]
            if size[q] == size[last] + 1:
                return q
            return self._split(last, symbol, q)
        cur = len(size)
        nxt.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][symbol]
            link[cur] = q if size[q] == size[p] + 1 else self._split(p, symbol, q)
        return cur

    def _split(self, p: int, symbol, q: int) -> int:
        """A state for the suffixes of q that end a string one longer than p's."""
        nxt, link, size = self.next, self.link, self.size
        clone = len(size)
        nxt.append(dict(nxt[q]))
        size.append(size[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(symbol) == q:
            nxt[p][symbol] = clone
            p = link[p]
        return clone

    def add(self, sequence) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)

    def matching(self, sequence) -> list[int]:
        """For each symbol, the length of the longest known factor that ends there."""
        state, n, out = 0, 0, []
        nxt, link, size = self.next, self.link, self.size
        for symbol in sequence:
            while state and symbol not in nxt[state]:
                state = link[state]
                n = size[state]
            if symbol in nxt[state]:
                state = nxt[state][symbol]
                n += 1
            else:
                n = 0
            out.append(n)
        return out


def automaton_matcher(words: int):
    def match(pieces: list, places: list, keys: list) -> list:
        out: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, x in enumerate(keys):
            groups.setdefault(x, []).append(i)
        for members in groups.values():
            members.sort(key=lambda i: places[i])
            reference, waiting, doc = SuffixAutomaton(), [], None
            for i in members:
                if places[i][0] != doc:              # only smaller ids are the reference
                    for sequence in waiting:
                        reference.add(sequence)
                    waiting, doc = [], places[i][0]
                sequence = pieces[i].split(b" ")
                out[i] = np.array(reference.matching(sequence)[words - 1:]) >= words
                waiting.append(sequence)
        return out
    return match


def substring_dedup(docs: DataFrame, words: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word ranges), kept (words joined by one space) per row."""
    spec = Spec("word", words, max(1, min(GRAM_WORDS, words // 2)), within=False)
    return remove_repeats(docs, spec, automaton_matcher(words)).select(
        F.col("rest.doc_id").cast("long").alias("doc_id"), F.col("n_units").alias("n_words"), "n_removed", "spans",
        F.col("kept").cast("string").alias("kept"))
