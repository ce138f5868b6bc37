"""License scans by a trained paragraph classifier (operator 9).

A text is cut into lines, and long lines into windows of ``WINDOW`` words that
overlap by half; paragraphs of several lines (runs of lines with words) are also
read as a whole, their lines joined, in such windows, so that wrapped notices are
seen whole.  Word 1- to 3-grams (those of the templates) feed a softmax regression over the
licence families and one class for paragraphs that are no licence.  It is
trained here: on the templates below in varied surroundings, and, for the
unknown class, on at most ``SAMPLE_LINES`` lines of the corpus (those with the
smallest hashes) and on sentences that use the same words otherwise.  A
held-out part of that data sets the temperature (calibration) and the least
probability at which a family is named, so that no more than ``FALSE_RATE`` of
the unknown paragraphs pass.  A named family is confirmed if the paragraph
holds at least ``CONFIRM`` of some template's five-word shingles.

Words are lower-cased (A-Z) and parted by ASCII blanks and punctuation.  Nulls:
a null text has no paragraphs; a null doc_id stays null.  Paragraphs without
words belong to no family.  Repeated rows are scanned each; of the windows of a
line the most probable one per family is returned, and a notice over several
lines once, at its first line, in place of unconfirmed parts of it.  Other columns are not read.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.llm.common import flat_bytes
from kalulu.llm.repeats import _mix, word_hashes

WINDOW = 60
SAMPLE_LINES = 4000
SAMPLE_CHARS = 2000        # of a sampled line, for fitting only
FALSE_RATE = 0.001
CONFIRM, SHINGLE = 0.8, 5

# licence notices, by family: fixed values
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.", "Released under the GNU GPL v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.", "Released under the GNU GPL v2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1 or later.", "Released under the GNU LGPL.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.", "Released under the GNU AGPL v3."],
    "BSD": [
        "Released under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "CC-BY": [
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Content is available under CC BY 3.0."],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC-ND 4.0."],
    "CC0": ["Released into the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "Proprietary": [
        "All rights reserved.", "Copyright the authors. All rights reserved.", "No part of this publication may be reproduced without prior written permission of the publisher.",
        "This document is confidential and proprietary. Unauthorized copying is prohibited."],
}
# the same words in other uses: fixed values
OTHER_USES = [
    "He lost his driving license on the way home.", "The general public was not admitted to the library.", "A license plate was found under the car.",
    "She asked for permission to leave the work early.", "The software version of the story is free to read.", "The MIT campus lies by the river.",
    "An Apache helicopter landed in version two of the film.", "Commons in the village are open to the public.", "He had the copyright page torn out.",
    "Under the terms of the treaty the border is open.", "The fishing license was granted free of charge.", "Notice of the meeting shall be included in the letter.",
    "Students at MIT released a new film under the open sky.", "The creative class meets without restriction.",
]
FAMILIES = [*TEMPLATES, "unknown"]
UNKNOWN = len(TEMPLATES)

_PUNCT = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[list(_PUNCT) + [9, 11, 12, 13]] = 32


def words_of(text: str) -> list[str]:
    return bytes(_FOLD[np.frombuffer(text.encode(), np.uint8)]).decode().split()


class Paragraphs:
    """Word hashes of a batch of texts and the windows of words to classify."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        n = len(off) - 1
        padded = np.full(len(data) + n, 10, np.uint8)
        keep = np.ones(len(padded), bool)
        keep[off[1:] + np.arange(n)] = False
        padded[keep] = data
        folded = _FOLD[padded]
        line_end = np.flatnonzero(folded == 10)
        space = (folded == 32) | (folded == 10)
        edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.raw = padded
        self.start, self.end = start, end
        self.hash = word_hashes(folded, start, end)
        # words of each line, and the document of each line
        bound = np.searchsorted(start, line_end)
        lo = np.concatenate(([0], bound[:-1])) if len(bound) else np.zeros(0, np.int64)
        doc = np.searchsorted(off[1:] + np.arange(n), line_end)
        first_line = np.searchsorted(doc, np.arange(n))
        size = bound - lo
        windows = np.maximum(1, -(-(size - WINDOW) // (WINDOW // 2)) + 1) * (size > 0)
        line = np.repeat(np.arange(len(size)), windows)
        nth = np.arange(len(line)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.lo = lo[line] + nth * (WINDOW // 2)
        self.hi = np.minimum(self.lo + WINDOW, bound[line])
        self.doc, self.line = doc[line], line - first_line[doc[line]]
        self.bound, self.size = bound, size
        self.line_doc, self.first_line = doc, first_line

    def joined(self) -> "Paragraphs":
        """The windows of the paragraphs of several lines, their lines joined; ``line`` is the first word's."""
        held = np.flatnonzero(self.size > 0)
        new = np.ones(len(held), bool)
        new[1:] = (np.diff(held) > 1) | (np.diff(self.line_doc[held]) > 0)
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(held)) - 1 if len(head) else head
        several = last > head
        first, last = held[head[several]], held[last[several]]
        lo, hi = self.bound[first] - self.size[first], self.bound[last]
        windows = np.maximum(1, -(-(hi - lo - WINDOW) // (WINDOW // 2)) + 1)
        of = np.repeat(np.arange(len(lo)), windows)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        p = copy.copy(self)
        p.lo = lo[of] + nth * (WINDOW // 2)
        p.hi = np.minimum(p.lo + WINDOW, hi[of])
        p.doc = self.line_doc[first[of]]
        p.line = self.lines_of(p.lo)
        p.paragraph = of
        return p

    def lines_of(self, words: np.ndarray) -> np.ndarray:
        """The line in its text of each word, by number."""
        line = np.searchsorted(self.bound, words, "right")
        return line - self.first_line[self.line_doc[line]]

    def gram_hashes(self) -> list[np.ndarray]:
        h, out = self.hash, []
        key = np.zeros(len(h), np.uint64)
        for n in range(3):
            key = (key[:-1] if n else key) * np.uint64(0x9E3779B97F4A7C15) + h[n:]
            out.append(_mix(key + np.uint64(n)))
            if len(h) <= n + 1:
                break
        return out

    def grams(self, known: np.ndarray) -> list[np.ndarray]:
        """Number of each gram among ``known`` (sorted hashes), or one past the last."""
        out = []
        for h in self.gram_hashes():
            i = np.minimum(np.searchsorted(known, h), len(known) - 1)
            out.append(np.where(known[i] == h, i, len(known)))
        return out

    def hits(self, known: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, number of a known gram in it) pairs, each once."""
        pairs = [np.zeros(0, np.int64)]
        for n, g in enumerate(self.grams(known)):
            at = np.flatnonzero(g < len(known))
            first = np.searchsorted(at, lo)
            size = np.maximum(0, np.searchsorted(at, hi - n) - first)
            window = np.repeat(np.arange(len(lo)), size)
            nth = np.arange(len(window)) - np.repeat(np.cumsum(size) - size, size)
            pairs.append(window * len(known) + g[at[first[window] + nth]])
        pairs = np.unique(np.concatenate(pairs))
        return pairs // len(known), pairs % len(known)

    def sums(self, known: np.ndarray, weights: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Sum of the weight rows of the grams inside each window, each gram once."""
        out = np.zeros((len(lo), weights.shape[1]))
        window, gram = self.hits(known, lo, hi)
        if len(window):
            head = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
            out[window[head]] = np.add.reduceat(weights[gram].astype(np.float64), head, axis=0)
        return out

    def text(self, i: int) -> str:
        return bytes(self.raw[self.start[self.lo[i]]:self.end[self.hi[i] - 1]]).decode("utf-8", "replace")


def _paragraphs(texts: list[str]) -> Paragraphs:
    """One paragraph per text (line ends are blanks here)."""
    return Paragraphs(*flat_bytes(pa.array([x.replace("\n", " ") for x in texts], pa.string())))


def _shingles(words: list[str]) -> set[tuple]:
    n = min(SHINGLE, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


_TEMPLATE_SHINGLES = {f: [_shingles(words_of(t)) for t in ts] for f, ts in TEMPLATES.items()}


def template_similarity(family: str, text: str) -> float:
    """The largest share of a template's shingles that the text holds."""
    words = words_of(text)
    held: dict[int, set] = {}
    best = 0.0
    for s in _TEMPLATE_SHINGLES.get(family, ()):
        n = len(next(iter(s)))
        if n not in held:
            held[n] = set(zip(*(words[i:] for i in range(n))))
        best = max(best, len(s & held[n]) / len(s))
    return best


def template_share(shingles: set[tuple], words: list[str]) -> float:
    n = len(next(iter(shingles)))
    return len(shingles & set(zip(*(words[i:] for i in range(n))))) / len(shingles)


def notices_in(family: str, text: str) -> list[tuple[int, int, float]]:
    """(first word, last word, share of the shingles) of each notice that confirms a template of the family."""
    words, out = words_of(text), []
    for s in _TEMPLATE_SHINGLES.get(family, ()):
        n = len(next(iter(s)))
        runs, seen = [], set()
        for i, x in enumerate(zip(*(words[j:] for j in range(n)))):
            if x in s:
                if x in seen or not runs:           # a shingle comes again: the next notice
                    runs.append([i, i, 0])
                    seen = set()
                seen.add(x)
                runs[-1][1:] = i, len(seen)
        sure = [(a, z + n - 1, m / len(s)) for a, z, m in runs if m / len(s) >= CONFIRM]
        share = template_share(s, words)
        out += sure or ([(runs[0][0], runs[-1][1] + n - 1, share)] if share >= CONFIRM else [])
    return out


def training_texts(lines: list[str], seed: int = 9) -> tuple[list[str], np.ndarray]:
    """Templates in varied surroundings, sampled lines and other uses, with their classes."""
    rnd = np.random.default_rng(seed)
    def window(words: list[str], size: int) -> list[str]:
        at = int(rnd.integers(0, max(1, len(words) - size + 1)))
        return words[at:at + size]
    other = [w for x in lines for w in window(x.split(), 40)] or ["word"]
    texts, y = [], []

    def around(words: list[str], most: int) -> str:
        room = max(0, min(most, WINDOW - len(words)))       # the whole stays one window
        before = rnd.integers(0, room + 1)
        after = rnd.integers(0, room - before + 1)
        pick = lambda n: [other[i] for i in rnd.integers(0, len(other), n)]
        return " ".join([*pick(before), *words, *pick(after)])
    for k, (_, templates) in enumerate(TEMPLATES.items()):
        for t in templates:
            words = t.split()
            for i in range(40):
                kept = [w for w in words if rnd.random() > (0.1 if i % 2 and len(words) > 7 else 0)]
                texts.append(around(kept, 0 if i % 4 == 0 else WINDOW))
                y.append(k)
    for t in OTHER_USES:
        for i in range(30):
            texts.append(around(t.split(), WINDOW if i else 0))
            y.append(UNKNOWN)
    words = sorted({w for ts in TEMPLATES.values() for t in ts for w in t.split()})
    for _ in range(600):      # licence words in no order
        texts.append(around([words[i] for i in rnd.integers(0, len(words), rnd.integers(1, 8))], WINDOW))
        y.append(UNKNOWN)
    for t in lines:
        if max(template_similarity(f, t) for f in TEMPLATES) < 0.5:
            texts.append(" ".join(window(t.split(), WINDOW)))
            y.append(UNKNOWN)
    return texts, np.array(y)


def _known_grams() -> np.ndarray:
    """Hashes of the n-grams of the templates and of the other uses: the only features,
    so that surroundings do not outweigh a notice."""
    p = _paragraphs([t for ts in TEMPLATES.values() for t in ts] + OTHER_USES)
    found = [g[lo:max(lo, hi - n)] for n, g in enumerate(p.gram_hashes()) for lo, hi in zip(p.lo, p.hi)]
    return np.unique(np.concatenate(found))


class Classifier:
    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float, least: float):
        self.known, self.weights, self.bias, self.temperature, self.least = known, weights, bias, temperature, least

    def probabilities(self, p: Paragraphs) -> np.ndarray:
        z = (p.sums(self.known, self.weights, p.lo, p.hi) + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
        return z / z.sum(axis=1, keepdims=True)


def fit(lines: list[str], steps: int = 60, rate: float = 0.3, decay: float = 1e-4) -> Classifier:
    """Softmax regression by full-batch AdaGrad, then calibration on the held-out fifth."""
    texts, y = training_texts(lines)
    p = _paragraphs(texts)
    keep = np.unique(p.doc, return_index=True)[1]         # the first window of each text
    y, lo, hi = y[p.doc[keep]], p.lo[keep], p.hi[keep]
    known = _known_grams()
    row, idx = p.hits(known, lo, hi)
    fold = np.random.default_rng(1).random(len(y)) < 0.2
    k = len(FAMILIES)
    one = np.eye(k)[y]
    w, b = np.zeros((len(known), k)), np.zeros(k)
    gw, gb = np.full_like(w, 1e-6), np.full(k, 1e-6)
    used, inverse = np.unique(idx, return_inverse=True)
    by = np.argsort(inverse, kind="stable")
    heads = np.searchsorted(inverse[by], np.arange(len(used)))
    full = np.unique(row)
    row_heads = np.searchsorted(row, full)

    def logits():
        z = np.zeros((len(y), k))
        z[full] = np.add.reduceat(w[idx], row_heads, axis=0)
        return z + b

    def soft(z, t=1.0):
        e = np.exp(z / t - (z / t).max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    for _ in range(steps):
        r = (soft(logits()) - one) * ~fold[:, None] / np.sqrt((~fold).sum())
        g = np.add.reduceat(r[row[by]], heads, axis=0) + decay * w[used]
        gw[used] += g * g
        w[used] -= rate * g / np.sqrt(gw[used])
        gb += r.sum(axis=0) ** 2
        b -= rate * r.sum(axis=0) / np.sqrt(gb)
    z, yh = logits()[fold], y[fold]
    loss = {t: -np.log(soft(z, t)[np.arange(len(yh)), yh] + 1e-12).mean() for t in np.geomspace(0.25, 4, 25)}
    t = min(loss, key=loss.get)
    q = soft(z, t)
    wrong = np.sort(q[yh == UNKNOWN, :UNKNOWN].max(axis=1))[::-1]
    allowed = int(len(wrong) * FALSE_RATE)
    least = max(2 / k, float(wrong[min(allowed, len(wrong) - 1)]) + 1e-6) if len(wrong) else 0.5
    return Classifier(known, w.astype(np.float32), b, float(t), min(least, 0.999))


def sample_lines(docs: DataFrame, most: int = SAMPLE_LINES) -> list[str]:
    """At most ``most`` distinct lines of the corpus, those of the smallest hashes; of a long one a window placed by its hash.

    Hashes are made distinct before any limit, so that a repeated line takes
    one place; only they are shuffled, the lines themselves are read again.
    """
    lines = docs.select(F.explode(F.split(F.col("text").cast("string"), "\n")).alias("x")).where("x <> ''")
    lines = lines.select("x", F.xxhash64("x").alias("h"))
    picked = lines.select("h").distinct().orderBy("h").limit(most)
    at = F.pmod("h", F.greatest(F.length("x") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    found = lines.join(F.broadcast(picked), "h").groupBy("h").agg(F.min(F.substring("x", at, F.lit(SAMPLE_CHARS))).alias("x"))     # most hashes at most
    return [r.x for r in found.orderBy("h").collect()]


_FOUND = "doc_id bigint, line bigint, family string, probability double, similarity double, confirmed boolean, paragraph string"


def _over_lines(model: Classifier, p: Paragraphs, rows: dict[tuple, tuple]) -> None:
    """Adds to ``rows`` the notices that span lines; unconfirmed parts of a confirmed one go."""
    q = model.probabilities(p)
    best = q.argmax(axis=1) if len(q) else np.zeros(0, int)
    named = [(float(q[i, best[i]]), i) for i in np.flatnonzero(best != UNKNOWN).tolist() if q[i, best[i]] >= model.least]
    sure, doubtful = {}, {}
    for prob, i in sorted(named, reverse=True):
        k, d = int(best[i]), int(p.doc[i])
        text = p.text(i).replace("\n", " ")
        found = notices_in(FAMILIES[k], text)
        for a, z, share in found:
            first, last = p.lines_of(p.lo[i] + np.array([a, z])).tolist()
            key = (d, first, k)
            if key not in sure or share > sure[key][1]:
                sure[key] = (prob, share, text, last)
        if not found:
            doubtful.setdefault((d, int(p.paragraph[i]), k), (prob, i, text))
    covered: dict[tuple, set] = {}
    for (d, first, k), (prob, share, text, last) in sure.items():
        covered.setdefault((d, k), set()).update(range(first, last + 1))
    for d, line, k in [x for x, row in rows.items() if row[1] < CONFIRM and x[1] in covered.get((x[0], x[2]), ())]:
        del rows[d, line, k]
    for (d, first, k), (prob, share, text, _) in sure.items():
        if (d, first, k) not in rows:
            rows[d, first, k] = (prob, share, text)
    for (d, _, k), (prob, i, text) in doubtful.items():
        first, last = p.lines_of(np.array([p.lo[i], p.hi[i] - 1])).tolist()
        lines = range(first, last + 1)
        if not any((d, x, k) in rows for x in lines) and covered.get((d, k), set()).isdisjoint(lines):
            rows[d, first, k] = (prob, template_similarity(FAMILIES[k], text), text)


def scan(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """A row per line and licence family named in it, or in the lines from it on."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)   # the templates' n-grams x families

    def run(batches):
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                p = Paragraphs(*flat_bytes(part.column(1)))
                q = model.probabilities(p)
                best = q.argmax(axis=1) if len(q) else np.zeros(0, int)
                hits: dict[tuple, tuple] = {}
                for i in np.flatnonzero(best != UNKNOWN).tolist():
                    k, prob = int(best[i]), float(q[i, best[i]])
                    where = (int(p.doc[i]), int(p.line[i]), k)
                    if prob >= model.least and (where not in hits or prob > hits[where][0]):
                        hits[where] = (prob, p.text(i))
                found = {x: (prob, template_similarity(FAMILIES[x[2]], text), text) for x, (prob, text) in hits.items()}
                _over_lines(model, p.joined(), found)
                rows = []
                for (d, line, k), (prob, s, text) in sorted(found.items()):
                    rows.append((part.column(0)[d].as_py(), line, FAMILIES[k], prob, s, s >= CONFIRM, text))
                cols = list(zip(*rows)) or [()] * 7
                types = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.string()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in _FOUND.split(", ")])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _FOUND)
