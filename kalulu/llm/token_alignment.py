"""Alignment of two tokenizers over one text (operator 13).

Each text is encoded as space + text by a byte-level BPE (A) and by a piece
BPE with byte fallback (B, which adds the space itself), without special
tokens.  Per stretch of text the cumulative byte ends of either side are keys
of a dictionary, end -> index; the sorted keys that both hold slice the two id
lists into groups, and each slice is expanded into its links: the pairs whose
byte ranges end together.  Tokens have at least one byte, so these are the last
tokens of a slice.  How many links of the corpus hold an id pair is its count.

Stretches.  Neither tokenizer joins bytes across a blank that follows a
non-blank (checked against B's vocabulary).  Texts are cut there, and a task
encodes each distinct stretch once, many in one call, and keeps a bounded
number; the ids are those of the whole text (tested).

Two scans: the first counts the distinct stretches (in the task, then by
Spark), of which each is aligned once to count id pairs; the second aligns the
texts and reads the counts.  The pairs are at most the product of
the two vocabularies, whatever the corpus; they are broadcast in shards of
``SHARD_PAIRS``, one shard at a time, with a checkpoint between shards.

Nulls: a null text, an empty one, and one whose bytes the tokens of A or B do
not give back (for instance with U+2581, B's sign for a blank) have no tokens:
zeros, empty groups, no share in the counts.  Repeated rows count each.  An
empty table gives no rows.  Other columns are not read.  A task holds the
stretches of one text, about ten times its size.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.llm.common import checkpoint, parts_for

FOLDER = "/opt/tokenizers"
SHARD_PAIRS = 2_000_000    # id pairs of one broadcast: 34 MB
KEEP_WORDS = 400_000       # aligned stretches that a worker keeps
FLUSH_WORDS = 300_000      # distinct stretches that a task counts before it writes them out
FLUSH_PAIRS = 400_000      # id pairs that a task holds before it writes them out
SLICE_CHARS = 1 << 20      # text that is aligned at once
TOGETHER = 2_000            # stretches encoded by one call
SIDE = 1 << 17             # a pair's key is a * SIDE + b

_BLANK = "▁"
_DOUBLE = re.compile(r"\s ")
_AT_BLANK = re.compile(r"(?<=\S)(?= )")
_LATIN = re.compile("[\n !-~¡-ɏ]*")      # both encoders of A agree on these


def _byte_level() -> dict[str, int]:
    """Characters that a byte-level vocabulary writes for bytes: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def split(text: str):
    """The stretches of space + text, each without its first blank, at most ``SLICE_CHARS`` of text at a time."""
    if _DOUBLE.search(text) or text[0].isspace():
        whole = " " + text
        words = [x[1:] for x in _AT_BLANK.split(whole)]
    elif len(text) <= SLICE_CHARS:
        words = text.split(" ")
    else:                                          # no blank follows a blank: cut anywhere at a blank
        lo = 0
        while lo < len(text):
            hi = text.find(" ", lo + SLICE_CHARS)
            hi = hi if hi >= 0 else len(text)
            yield text[lo:hi].split(" ")
            lo = hi + 1
            if lo == len(text):                    # the text ends in this blank
                yield [""]
        return
    for at in range(0, len(words), SLICE_CHARS // 4):
        yield words[at:at + SLICE_CHARS // 4]


class Aligner:
    """Both tokenizers and the stretches aligned so far."""

    def __init__(self, folder: str = FOLDER):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        path = f"{folder}/byte_bpe_50k.json"
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte = _byte_level()
        ids = {x: bytes(byte[c] for c in x) for x in model["vocab"] if all(c in byte for c in x)}
        self.a_bytes = {model["vocab"][x]: raw for x, raw in ids.items()}
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        ranked = [model["vocab"][a + b] for a, b in merges]
        self.quick = None
        if ranked == sorted(ranked):        # ids are in the order of the merges: the ranks of the faster encoder
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            special = {x["id"] for x in json.load(open(path, encoding="utf-8"))["added_tokens"]}
            self.quick = tiktoken.Encoding("a", pat_str=pattern, special_tokens={}, mergeable_ranks={
                raw: i for i, raw in self.a_bytes.items() if i not in special})
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        self.b_bytes, joined = {}, set()
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes[i] = bytes([int(piece[3:5], 16)])
            elif not self.b.is_control(i) and not self.b.is_unknown(i):
                self.b_bytes[i] = piece.replace(_BLANK, " ").encode()
                joined |= set(zip(piece, piece[1:]))
        if any(y == _BLANK and x != _BLANK for x, y in joined) :
            raise ValueError("pieces of the model reach across blanks")
        line = next(i for i, raw in self.b_bytes.items() if raw == b"\n" and self.b.is_byte(i))
        self.line_end = next(i for i, raw in self.a_bytes.items() if raw == b"\n"), line
        if "\n" in "".join(x + y for x, y in joined):
            raise ValueError("pieces of the model reach across line ends")
        size = lambda raws, n: np.array([len(raws.get(i, b"")) for i in range(n)], np.int64)
        self.a_size, self.b_size = size(self.a_bytes, max(self.a_bytes) + 2), size(self.b_bytes, self.b.get_piece_size())
        written = lambda n, end: np.array([f"{i}{end}" for i in range(n)], object)
        self.a_text = written(len(self.a_size), ","), written(len(self.a_size), "|")
        self.b_text = written(len(self.b_size), ","), written(len(self.b_size), ";")

    def encode(self, words: list[str]) -> "Encoded":
        """Aligns stretches, each without its first blank; those whose bytes do not come back have no tokens and are marked bad."""
        plain = [i for i, w in enumerate(words) if w and not w[0].isspace() and not w[-1].isspace()]
        done: list[tuple] = []                          # (places of words, their A ids, their B ids)
        for at in range(0, len(plain), TOGETHER):
            self._together(words, plain[at:at + TOGETHER], done)
        skip = set(plain)
        self._one_by_one(words, [i for i in range(len(words)) if i not in skip], done)
        return self._slice(words, done)

    def _a_ids(self, text: str) -> list[int]:
        return self.quick.encode_ordinary(text) if self.quick and _LATIN.fullmatch(text) else self.whole.encode(text, add_special_tokens=False).ids

    def _together(self, words: list[str], places: list[int], done: list) -> None:
        """One call for many stretches, a line end between two: it is a token of its own on either side."""
        text = "\n ".join([words[i] for i in places])
        a, b = np.array(self._a_ids(" " + text), np.int64), np.array(self.b.encode(text, num_threads=1), np.int64)
        size = np.fromiter((len(words[i].encode()) for i in places), np.int64, len(places))
        line = np.cumsum(size + 2)[:-1]                 # where the line ends end, in bytes
        a_cut, b_cut = np.searchsorted(np.cumsum(self.a_size[a]), line), np.searchsorted(np.cumsum(self.b_size[b]), line)
        if (self._raw(a, b) == ((" " + text).encode(),) * 2 and (a[a_cut] == self.line_end[0]).all() and (b[b_cut] == self.line_end[1]).all()):
            done.append((places, a, a_cut, b, b_cut))
        else:
            self._one_by_one(words, places, done)

    def _raw(self, a, b) -> tuple[bytes, bytes]:
        return b"".join([self.a_bytes.get(i, b"") for i in a.tolist()]), b"".join([self.b_bytes.get(i, b"") for i in b.tolist()])

    def _one_by_one(self, words: list[str], places: list[int], done: list) -> None:
        for i in places:
            text, none = " " + words[i], np.zeros(0, np.int64)
            a = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int64)
            b = self.b.encode(words[i]) if words[i] else [self.b.piece_to_id(_BLANK)]        # B writes nothing for a lone blank at the end
            b = np.array(b, np.int64)
            fine = self._raw(a, b) == (text.encode(),) * 2
            done.append(([i], a if fine else none, none, b if fine else none, none))

    def _slice(self, words: list[str], done: list) -> "Encoded":
        out = Encoded([""] * len(words), *np.zeros((3, len(words)), np.int64), [], [])
        for places, a, a_cut, b, b_cut in done:
            if not len(a):
                continue
            x, y = shared_ends(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
            before_x, before_y = np.concatenate([[0], x[:-1]]), np.concatenate([[0], y[:-1]])
            # "a1,a2|b1;a3|b2,b3": the A ids of a group stand before its B ids
            piece = np.empty(len(a) + len(b), object)
            for ids, text, stop, other in ((a, self.a_text, x, before_y), (b, self.b_text, y, x)):
                token = np.arange(len(ids))
                group = np.searchsorted(stop, token, "right")
                last = token + 1 == stop[group]
                piece[token + other[group]] = np.where(last, text[1][ids], text[0][ids])
            link = a[x - 1] * SIDE + b[y - 1]
            edge = np.concatenate([a_cut, [len(a)]])
            own = np.searchsorted(edge, before_x, "right")                          # which word a group is of; line ends are groups of none
            none = np.zeros(len(x), bool)
            none[np.searchsorted(x, a_cut + 1)] = True
            where = np.array(places)
            lo_a, lo_b = np.concatenate([[0], a_cut + 1]), np.concatenate([[0], b_cut + 1])
            hi_a, hi_b = edge, np.concatenate([b_cut, [len(b)]])
            out.n_a[where], out.n_b[where] = hi_a - lo_a, hi_b - lo_b
            out.n_links[where] = np.bincount(own[~none], minlength=len(places))
            for i, lo, hi in zip(places, (lo_a + lo_b).tolist(), (hi_a + hi_b).tolist()):
                out.groups[i] = "".join(piece[lo:hi])[:-1]
            out.owner.append(where[own[~none]])
            out.links.append(link[~none])
        return out


class Encoded(NamedTuple):
    """Stretches aligned together; ``links`` and the places of the stretches they are of, ``owner``, are in pieces."""

    groups: list[str]
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    owner: list[np.ndarray]
    links: list[np.ndarray]

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        none = [np.zeros(0, np.int64)]
        return np.concatenate(self.owner or none), np.concatenate(self.links or none)


def shared_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of either side end at or before each byte end that both have."""
    at_a = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1)))
    at_b = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1)))
    common = sorted(at_a.keys() & at_b.keys())
    return np.array(list(map(at_a.__getitem__, common)), np.int64), np.array(list(map(at_b.__getitem__, common)), np.int64)


_ALIGNERS: dict[str, Aligner] = {}


def aligner(folder: str) -> Aligner:
    """One for each worker process and folder."""
    if folder not in _ALIGNERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ALIGNERS[folder] = Aligner(folder)
    return _ALIGNERS[folder]


def _slices(batch: pa.RecordBatch, at: int):
    """Row numbers and texts of a batch, about ``SLICE_CHARS`` of text at a time; texts B cannot give back are empty."""
    column, rows, texts, size = batch.column(at), [], [], 0
    for i in range(batch.num_rows):
        text = column[i].as_py() or ""
        rows.append(i)
        texts.append("" if _BLANK in text else text)
        size += len(text) + 64
        if size >= SLICE_CHARS:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def _stretches(texts: list[str]) -> list[list[list[str]]]:
    """Per text its stretches, in slices."""
    return [list(split(t)) if t else [] for t in texts]


def _pair_rows(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    found, place = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place.reshape(-1), n)
    return pa.record_batch({"pair": pa.array(found), "n": pa.array(total)})


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the corpus's stretches and how often each occurs; texts that B cannot give back left out."""
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for _, texts in _slices(batch, 0):
                for t in texts:
                    for words in split(t) if t else ():
                        held.update(words)
                if len(held) > FLUSH_WORDS:
                    yield pa.record_batch({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
                    held.clear()
        yield pa.record_batch({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
    words = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def link_counts(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """pair (a * SIDE + b), n: how many links of the corpus hold each id pair.

    Each distinct stretch is aligned once and its links counted as often as it
    occurs.  Should a side not give back a stretch's bytes, whole texts have
    no links: these are counted text by text then.
    """
    def run(batches):
        al = aligner(folder)
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                n = part.column(1).to_numpy()
                found = al.encode(part.column(0).to_pylist())
                owner, links = found.flat()
                bad = found.n_a == 0
                yield _pair_rows(np.concatenate([links, np.full(int(bad.sum()), -1)]), np.concatenate([n[owner], n[bad]]))
    counts = checkpoint(vocabulary(docs).mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))
    return _by_text(docs, folder) if counts.where("pair < 0").head(1) else counts


def _by_text(docs: DataFrame, folder: str) -> DataFrame:
    def run(batches):
        al = aligner(folder)
        for batch in batches:
            for _, texts in _slices(batch, 0):
                for p in _stretches(texts):
                    found = al.encode([w for words in p for w in words])
                    if (found.n_a > 0).all():
                        links = found.flat()[1]
                        yield _pair_rows(links, np.ones(len(links), np.int64))
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def best_links(counts: DataFrame) -> DataFrame:
    """pair, n, best: best where no other A id has more links with the pair's B id."""
    b = F.col("pair") % SIDE
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


_OUT = "doc_id bigint, {text}n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint{groups}"


_FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class _Memory:
    """The stretches a task has aligned: their groups, and their figures under one shard of the pair counts."""

    def __init__(self, al: Aligner, pairs: np.ndarray, n: np.ndarray, best: np.ndarray):
        self.al, self.pairs, self.n, self.best = al, pairs, n, best
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.figures = np.zeros((1024, len(_FIGURES)), np.int64)

    def learn(self, words) -> None:
        if len(self.groups) > KEEP_WORDS:
            self.forget()
        new = [w for w in words if w not in self.place]
        if not new:
            return
        found, first = self.al.encode(new), len(self.groups)
        owner, links = found.flat()
        at = np.minimum(np.searchsorted(self.pairs, links), max(0, len(self.pairs) - 1))
        hit = self.pairs[at] == links if len(self.pairs) else np.zeros(len(links), bool)
        while len(self.figures) < first + len(new):
            self.figures = np.concatenate([self.figures, np.zeros_like(self.figures)])
        here = self.figures[first:first + len(new)]
        for i, x in enumerate((found.n_a, found.n_b, found.n_links, found.n_links)):
            here[:, i] = x
        here[:, 4:] = 0
        np.add.at(here[:, 4], owner[hit], self.best[at[hit]])
        np.add.at(here[:, 5], owner[hit], self.n[at[hit]])
        self.place.update(zip(new, range(first, first + len(new))))
        self.groups += found.groups


def _score(rows: DataFrame, shared, folder: str, first: bool, last: bool) -> DataFrame:
    """Adds what a shard of the pair counts gives; the first adds the sizes, the last the groups in place of the text."""
    def run(batches):
        memory = _Memory(aligner(folder), *shared.value)
        for batch in batches:
            for rows_, texts in _slices(batch, 1):
                parts = _stretches(texts)
                memory.learn(dict.fromkeys(w for p in parts for words in p for w in words))
                place, groups = memory.place, memory.groups
                ids = [list(map(place.__getitem__, words)) for p in parts for words in p]
                sizes = [sum(map(len, p)) for p in parts]
                figures = memory.figures[np.fromiter((i for x in ids for i in x), np.int64, sum(sizes))]
                each = np.zeros((len(parts), len(_FIGURES)), np.int64)
                np.add.at(each, np.repeat(np.arange(len(parts)), sizes), figures)
                bad = np.zeros(len(parts), bool)
                bad[np.repeat(np.arange(len(parts)), sizes)[figures[:, 0] == 0]] = True       # a stretch without tokens empties its text
                each[bad] = 0
                text, at = [], 0
                for i, p in enumerate(parts):
                    text.append("" if bad[i] or not last else ";".join([groups[j] for x in ids[at:at + len(p)] for j in x]))
                    at += len(p)
                part = batch.slice(rows_[0], len(rows_))
                made = {"doc_id": part.column(0)} | ({} if last else {"text": part.column(1)})
                for i, name in enumerate(_FIGURES):
                    here = each[:, i] if first or i < 4 else each[:, i] + part.column(part.schema.get_field_index(name)).to_numpy()
                    made[name] = pa.array(np.ascontiguousarray(here), pa.int64())
                yield pa.record_batch(made | ({"groups": pa.array(text, pa.string())} if last else {}))
    schema = _OUT.format(text="" if last else "text string, ", groups=", groups string" if last else "")
    return rows.mapInArrow(run, schema)


def align(docs: DataFrame, folder: str = FOLDER, shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups ("a1,a2|b1;a3|b2,b3") of each row."""
    counts = checkpoint(best_links(link_counts(docs, folder)))
    shards = parts_for(counts.count(), shard_pairs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for s in range(shards):
        mine = counts.where(F.pmod(F.xxhash64("pair"), F.lit(shards)) == s).toArrow()       # id pairs, not documents: bounded by shard_pairs
        pairs = mine.column("pair").to_numpy()
        by = np.argsort(pairs)
        shared = docs.sparkSession.sparkContext.broadcast(
            (pairs[by], mine.column("n").to_numpy()[by], mine.column("best").to_numpy(zero_copy_only=False)[by].astype(np.int64)))
        rows = _score(rows, shared, folder, s == 0, s == shards - 1)
        if s < shards - 1:
            rows = checkpoint(rows)
    return rows
