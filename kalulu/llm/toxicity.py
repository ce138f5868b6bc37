"""Toxicity by a weighted finite-state pattern grammar (operator 4).

A text is cut into clauses.  A lexicon maps words to symbols (insult, threat,
target, negation, reported speech, other), and three transducers are composed
into one: negation marks insults and threats shortly after a negation, reported
speech those after a verb of saying, target those near a person word.  Run over
a clause it yields marked matches such as "insult at a target" or "negated,
reported threat"; a text is scored by its matched clauses, never by loose
words: each kind counts the clauses it occurs in.  The weights of the kinds are
fitted to ``labels.toxic`` by logistic regression that shrinks to prior
weights, so that kinds rare in the labels keep a sensible weight.

The insult words are a fixed list, and words and word beginnings (of
``STEM_CHARS`` characters) learned from the labels: those in ``MIN_TEXTS``
sampled texts or more, nearly all toxic.  Fixed words that the
labels contradict are dropped.  Learning uses the labelled rows outside the
held-out fold (crc32(doc_id as text) mod 5 is 0), at most about ``SAMPLE_ROWS``
of them, chosen by a hash of the id.  Equal texts count once there, toxic by
the share of their labels: copies are no evidence.  doc_id, lang, source and labels are never
inputs of a score.

Nulls: a null text is empty; texts without a matched clause score the base
rate; a null label is no label; of several labels of a document the largest
counts; a null doc_id is scored, never learned from.  Without labels the prior
weights hold.  Repeated rows are scored each.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.llm.common import checked_side, id_crc

SAMPLE_ROWS = 20_000
MIN_TEXTS = 6
STEM_CHARS = (4, 5, 6)
FOLDS = 5

# the grammar's words
INSULTS = """idiot idiots moron morons clown clowns loser losers stupid pathetic worthless scum trash disgusting
    imbecile fool fools dumb garbage vermin filth filthy jerk jerks coward cowards liar liars creep creeps bastard
    bastards degenerate subhuman parasite parasites ugly pig pigs rat rats disgrace""".split()
THREATS = "kill killed murder hurt destroy shoot stab strangle attack smash punish crush burn".split()
TARGETS = "you your yours you're youre u he she they them their him her his these those people everyone".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't won't can't nobody neither nor without hardly".split()
REPORTS = "said says say wrote writes quoted quote claimed claims called calls reported according tweeted stated".split()

NEGATION_REACH, TARGET_REACH = 3, 4
_CLAUSE = re.compile(rb"[.!?;:\n,]+")
_TRIM = b"\"'()[]{}<>*#$%&|_-~`"


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) -> (state, symbol); ``other`` states the move on any other symbol, which it copies."""

    arcs: dict = field(default_factory=dict)
    other: dict = field(default_factory=dict)

    def step(self, state, symbol):
        hit = self.arcs.get((state, symbol))
        return hit if hit else (self.other.get(state, state), symbol)

    def after(self, second: "Transducer") -> "Composed":
        return Composed(self, second)


@dataclass(frozen=True)
class Composed:
    """The composition: the second machine reads what the first writes."""

    first: object
    second: object

    def step(self, state, symbol):
        a, b = state if state else (0, 0)
        a, symbol = self.first.step(a, symbol)
        b, symbol = self.second.step(b, symbol)
        return (a, b), symbol

    def after(self, second) -> "Composed":
        return Composed(self, second)


_MARKS = [m + n + r for m in "IT" for n in ("", "-") for r in ("", '"')]


def _countdown(trigger: str, reach: int, mark: str, symbols: list[str]) -> Transducer:
    """Marks the symbols at most ``reach`` places after the trigger."""
    arcs = {(s, trigger): (reach, trigger) for s in range(reach + 1)}
    arcs |= {(s, x): (s - 1, x + mark) for s in range(1, reach + 1) for x in symbols}
    return Transducer(arcs, {s: max(0, s - 1) for s in range(reach + 1)})


def grammar() -> Composed:
    negation = _countdown("N", NEGATION_REACH, "-", ["I", "T"])
    reported = Transducer({(0, "R"): (1, "R")} | {(1, x): (1, x + '"') for x in ("I", "T", "I-", "T-")})
    target = _countdown("P", TARGET_REACH, "@", _MARKS)
    return negation.after(reported).after(target)


KINDS = [m + t for m in _MARKS for t in ("", "@")]
# prior weights of the kinds and of the base
_PRIOR = np.array([3.0 * (0.3 if "-" in k else 1) * (0.4 if '"' in k else 1) * (1.2 if "@" in k else (0.2 if k[0] == "T" else 1)) for k in KINDS] + [-3.0])


class Grammar:
    def __init__(self, insults: set[bytes], weights: np.ndarray = _PRIOR, stems: frozenset = frozenset()):
        """``stems``: beginnings of insults, as text."""
        self.stems, self.stem_sizes = stems, sorted({len(x) for x in stems})
        self.symbols = {w.encode(): s for s, ws in (("T", THREATS), ("P", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in ws}
        self.symbols |= {w: "I" for w in insults}
        self.loaded = {w for w, s in self.symbols.items() if s in "IT"}
        self.machine = grammar()
        self.weights = weights

    def symbol(self, word: bytes) -> str:
        known = self.symbols.get(word)
        if known is None and self.stems:
            text = word.decode("utf-8", "ignore")
            known = "I" if any(text[:n] in self.stems for n in self.stem_sizes) else None
        return known or "O"

    def kinds(self, text: str | None) -> dict[str, int]:
        """How many clauses hold each kind of match."""
        raw = (text or "").encode().lower()
        out: Counter = Counter()
        symbols = {w: self.symbol(w) for w in {x.strip(_EDGE) for x in raw.split()}}
        if not any(s in "IT" for s in symbols.values()):
            return out
        for clause in _CLAUSE.split(raw):
            read = [symbols.get(w) or self.symbol(w) for w in (x.strip(_EDGE) for x in clause.split())]
            if "I" in read or "T" in read:
                state, found = None, set()
                for s in read:
                    state, symbol = self.machine.step(state, s)
                    if symbol[0] in "IT":
                        found.add(symbol)
                out.update(found)
        return out

    def features(self, text: str | None) -> np.ndarray:
        n = self.kinds(text)
        return np.array([np.log2(1 + n[k]) for k in KINDS] + [1.0])

    def score(self, text: str | None) -> float:
        n = self.kinds(text)
        z = self.weights[-1] + sum(w * np.log2(1 + n[k]) for k, w in zip(KINDS, self.weights) if n.get(k))
        return float(1 / (1 + np.exp(-z)))


_EDGE = _TRIM + b".!?;:,"


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 2.0, m: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression by Newton steps, shrunk to the prior weights; ``m`` weighs the rows."""
    m = np.ones(len(y)) if m is None else m
    w = _PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (m * (p - y)) + ridge * (w - _PRIOR)
        h = (x * (m * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _labelled_sample(docs: DataFrame, labels: DataFrame, folds: int) -> DataFrame:
    """text, toxic of about SAMPLE_ROWS labelled documents outside the held-out fold, equal texts once: toxic is the share of their toxic labels."""
    mine = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_crc() % folds != 0))
    mine = mine.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    share = min(1.0, SAMPLE_ROWS / max(1, mine.count()))
    picked = checked_side(mine.where(F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1 << 30)) < int(share * (1 << 30))))
    rows = docs.join(picked, docs["doc_id"].cast("long") == picked["_id"]).select(
        docs["text"].cast("string").alias("text"), picked["_toxic"].alias("toxic"))
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    return rows.groupBy(F.sha2(F.col("text").cast("binary"), 256)).agg(
        F.first("text").alias("text"), (F.sum("toxic") / F.count("*")).alias("toxic")).select("text", "toxic")


def _words_seen(batches):
    for batch in batches:
        text, toxic = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        words, label = [], []
        for t, y in zip(text, toxic):
            seen = {w for w in (x.strip(_EDGE) for x in (t or "").encode().lower().split()) if w}
            text = [w.decode("utf-8", "ignore") for w in seen]
            seen |= {x[:n].encode() + b"*" for x in text for n in STEM_CHARS if len(x) >= n}
            words += seen
            label += [y] * len(seen)
        yield pa.record_batch({"word": pa.array(words, pa.binary()), "toxic": pa.array(label, pa.float64())})


def learn(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> Grammar:
    from kalulu.llm.common import checkpoint

    sample = checkpoint(_labelled_sample(docs, labels, folds))
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0.0))).first()
    fixed = {w.encode() for w in INSULTS}
    if not n or not toxic or toxic == n:
        return Grammar(fixed)
    base = toxic / n
    words = sample.mapInArrow(_words_seen, "word binary, toxic double").groupBy("word").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("toxic")).where(F.col("n") >= MIN_TEXTS)
    known = [F.lit(w) for w in sorted(fixed)]
    words = words.withColumn("p", F.col("toxic") / F.col("n"))
    strong = (F.col("p") >= max(0.9, 1 - base / 4)) & ((F.col("p") - base) * F.sqrt("n") >= 7 * (base * (1 - base)) ** 0.5)
    weak = F.col("word").isin(*known) & (F.col("p") < 2 * base)
    found = words.where(strong | weak).select("word", strong.alias("strong")).collect()   # bounded by the sample
    learned = {bytes(r.word) for r in found if r.strong}
    stems = frozenset(w[:-1].decode() for w in learned if w.endswith(b"*"))
    insults = (fixed | {w for w in learned if not w.endswith(b"*")}) - {bytes(r.word) for r in found if not r.strong}
    insults -= {w.encode() for ws in (TARGETS, NEGATIONS, REPORTS) for w in ws}
    grammar_ = Grammar(insults, stems=stems)

    def features(batches):
        for batch in batches:
            x = [grammar_.features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.record_batch({"x": pa.array(x, pa.list_(pa.float64())), "toxic": batch.column(1)})
    # equal feature rows are summed, so the fit sees a small table of distinct rows
    rows = sample.mapInArrow(features, "x array<double>, toxic double").groupBy("x").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).collect()
    x = np.array([r.x for r in rows for _ in (0, 1)])
    y = np.array([v for _ in rows for v in (1.0, 0.0)])
    m = np.array([v for r in rows for v in (r.t, r.n - r.t)], float)
    return Grammar(insults, fit_weights(x, y, m=m), stems)


def score_documents(docs: DataFrame, grammar_: Grammar) -> DataFrame:
    """doc_id, score (0 to 1) for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar_)   # a lexicon bounded by the sample

    def run(batches):
        g = shared.value
        for batch in batches:
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array([g.score(t.as_py()) for t in batch.column(1)], pa.float64())})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, score double")


def accept(docs: DataFrame, grammar_: Grammar, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar_)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        g = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):        # a batch can hold many long texts
                part = batch.slice(lo, 256)
                yield part.filter(pa.array([g.score(t) < threshold for t in part.column(at).to_pylist()], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
