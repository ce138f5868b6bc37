"""Language-model scores by a hashed maximum-entropy model (operator 1).

The model factors a token's probability by classes:
P(token | context) = P(class | context) * P(token | class).  The class of a
token is a softmax over hashed features of the context: the word before, the
word before that (a skip), the pair of the last two words' classes (an n-gram)
and the pair of the two before those (a skip n-gram).  A class is a topic and
a band of frequency; the end of a text is a class of its own.  Inside a class
the maximum-entropy solution with one feature per token is closed: a token's
share of the class's count.  The lowest band holds the words seen once; its
mass is spread over them and an estimate of the unseen words (Chao's, from the
words seen once and twice), over all topics for a word never seen.

Everything is learned from the training documents, by Spark jobs that cover
them all: document sketches are clustered into topics (Lloyd's rounds over a
checkpointed table); word counts per topic are gathered by shards of the
vocabulary, which answer every bucket of documents with its words' counts and
classes; each bucket is written once as coded tokens (checkpointed), which the
later passes read without a shuffle; the class weights are trained in ``ROUNDS`` rounds of distributed
gradient updates: each bucket runs AdaGrad steps over its tokens from the
shared weights, and the token-weighted mean of the results, summed in a tree,
is the next round's start.  Scores are computed in numpy batches over the
sparse (hashed) features.

Words are the lower-cased (A-Z) runs without ASCII blanks, known by 64-bit hashes
(two words share one with probability 2^-64).  The buckets grow in number with
the data, not in size; the shared weights have a fixed size.

Nulls: a null text is empty (one end token); a null doc_id is in the fold of
the empty id.  Rows of one doc_id and text are each counted.  Without training
documents the unigram base is uniform over nothing: log10(1) per token, and
the score is that base.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalulu.llm.common import checkpoint, flat_bytes, id_crc, parts_for, text_bytes
from kalulu.llm.repeats import _by_shard, _mix, normal_words, word_hashes

FOLDS, HELD_OUT = 7, 2
TOPICS, BANDS = 6, 5                       # bands by count: 1, 2-3, 4-15, 16-255, 256 and more
END = TOPICS * BANDS                       # the class of the end token
CLASSES = END + 1
START = CLASSES                            # "class" before the first token, as context only
WORD_FEATURES = 2048
PAIRS = (CLASSES + 1) ** 2
FEATURES = 2 * WORD_FEATURES + 2 * PAIRS
SKETCH = 64
ROUNDS = 2
BUCKET_BYTES, SHARD_BYTES = 2 << 20, 8 << 20
BATCH = 1 << 15
LOG10 = np.log(10.0)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def band_of(count: np.ndarray) -> np.ndarray:
    return np.searchsorted([2, 4, 16, 256], count, "right")


class Tokens:
    """Word hashes of texts back to back; ``off`` parts the documents."""

    def __init__(self, column):
        data, off = flat_bytes(column)
        data, start, end, self.off = normal_words(_LOWER[data], off)
        self.word = word_hashes(data, start, end)
        self.doc = np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))


# --- topics -------------------------------------------------------------------

def _sketches(word: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Signed hashed word counts of each document, scaled to length one."""
    x = _mix(word + np.uint64(77))
    at = doc * SKETCH + (x % np.uint64(SKETCH)).astype(np.int64)
    sign = np.where(x >> np.uint64(63), 1.0, -1.0)
    s = np.bincount(at, sign, n * SKETCH).reshape(n, SKETCH)
    return s / np.maximum(1e-9, np.linalg.norm(s, axis=1, keepdims=True))


def _nearest(sketch: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (sketch @ centres.T).argmax(axis=1) if len(sketch) else np.zeros(0, np.int64)


def fit_topics(train: DataFrame, parts: int, rounds: int = 6) -> np.ndarray:
    """Unit centres of the documents' sketches, by spherical k-means over all training documents."""
    def sketch(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):      # a batch can hold many long texts
                t = Tokens(batch.column(0).slice(lo, 256))
                s = _sketches(t.word, t.doc, len(t.off) - 1)[np.diff(t.off) > 0]
                yield pa.record_batch({"s": pa.array([x.astype(np.float32).tobytes() for x in s], pa.binary())})
    table = checkpoint(train.select("text").mapInArrow(sketch, "s binary"))
    # start far apart: each next centre is, of a few hashed documents, the least like those before
    first = [np.frombuffer(r.s, np.float32) for r in table.orderBy(F.xxhash64("s")).limit(256).collect()]
    if not first:
        return np.eye(TOPICS, SKETCH)
    pool, centres = np.array(first, float), [np.array(first[0], float)]
    while len(centres) < TOPICS:
        centres.append(pool[(pool @ np.array(centres).T).max(axis=1).argmin()])
    centres = np.array(centres)
    for _ in range(rounds):
        def sums(batches, centres=centres):
            total = np.zeros((TOPICS, SKETCH))
            for batch in batches:
                s = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(-1, SKETCH).astype(float)
                np.add.at(total, _nearest(s, centres), s)
            yield pa.record_batch({"s": pa.array([total.tobytes()], pa.binary())})
        new = _tree_sum(table.mapInArrow(sums, "s binary"), np.float64, parts).reshape(TOPICS, SKETCH)
        size = np.linalg.norm(new, axis=1, keepdims=True)
        centres = np.where(size > 0, new / np.maximum(size, 1e-9), centres)
    return centres


def _tree_sum(rows: DataFrame, dtype, count: int, fan: int = 64) -> np.ndarray:
    """Sum of equal-sized arrays, about ``fan`` to a task at each level of a tree; one array reaches the driver.

    ``count``: how many arrays there are, unless the session has more partitions.
    """
    count = max(count, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype).astype(np.float64) for x in table["s"].to_pylist())
        return pa.table({"s": pa.array([total.astype(dtype).tobytes()], pa.binary())})
    column = rows.select("s")
    while count > 1:
        count = parts_for(count, fan)
        column = column.groupBy(F.pmod(F.xxhash64("s"), F.lit(count))).applyInArrow(add, "s binary")
    found = [np.frombuffer(r.s, dtype).astype(np.float64) for r in column.collect()]
    return sum(found) if found else np.zeros(0)


# --- vocabulary ---------------------------------------------------------------

def _ask(centres: np.ndarray, shards: int):
    """Bucket: its distinct words with their training counts per topic."""
    def run(table: pa.Table) -> pa.Table:
        t = Tokens(table["text"])
        n = len(t.off) - 1
        topic = _nearest(_sketches(t.word, t.doc, n), centres)
        train = ~table["held"].to_numpy(zero_copy_only=False)
        words, inverse = np.unique(t.word, return_inverse=True)
        key = inverse * TOPICS + topic[t.doc]
        counts = np.bincount(key[train[t.doc]], minlength=len(words) * TOPICS).reshape(-1, TOPICS)
        order, which, at = _by_shard(words, shards)
        rows = []
        for s, x, y in zip(which, at[:-1], at[1:]):
            o = order[x:y]
            w, k = np.nonzero(counts[o])
            rows.append({"shard": int(s), "b": table["b"][0].as_py(), "words": words[o].tobytes(), "at": w.astype(np.int32).tobytes(),
                         "topic": k.astype(np.uint8).tobytes(), "n": counts[o][w, k].astype(np.uint32).tobytes()})
        return pa.Table.from_pylist(rows, schema=_ASKED)
    return run


_ASKED = pa.schema([("shard", pa.int32()), ("b", pa.int32())] + [(x, pa.binary()) for x in ("words", "at", "topic", "n")])
_ANSWER = pa.schema([("b", pa.int32()), ("shard", pa.int32()), ("count", pa.binary()), ("topic", pa.binary()), ("stats", pa.binary())])


def _answer(table: pa.Table) -> pa.Table:
    """Shard: each bucket's words with their counts and topics; once, the classes' sizes."""
    rows = table.to_pylist()
    words = [np.frombuffer(r["words"], np.uint64) for r in rows]
    every, inverse = np.unique(np.concatenate(words), return_inverse=True)
    total = np.zeros(len(every) * TOPICS)
    first = np.cumsum([0, *map(len, words)])
    for r, lo, hi in zip(rows, first[:-1], first[1:]):
        at = inverse[lo:hi][np.frombuffer(r["at"], np.int32)]
        total += np.bincount(at * TOPICS + np.frombuffer(r["topic"], np.uint8), np.frombuffer(r["n"], np.uint32), len(total))
    total = total.reshape(-1, TOPICS)
    count, topic = total.sum(axis=1).astype(np.int64), total.argmax(axis=1)
    known = count > 0
    cls = topic * BANDS + band_of(count)
    stats = np.zeros((4, END))                       # tokens, types, types seen once, types seen twice
    stats[0] = np.bincount(cls[known], count[known], END)
    stats[1] = np.bincount(cls[known], minlength=END)
    stats[2] = np.bincount(cls[count == 1], minlength=END)
    stats[3] = np.bincount(cls[count == 2], minlength=END)
    out = []
    for i, (r, lo, hi) in enumerate(zip(rows, first[:-1], first[1:])):
        x = inverse[lo:hi]
        out.append({"b": r["b"], "shard": r["shard"], "count": count[x].astype(np.int64).tobytes(),
                    "topic": topic[x].astype(np.uint8).tobytes(), "stats": stats.tobytes() if i == 0 else None})
    return pa.Table.from_pylist(out, schema=_ANSWER)


@dataclass
class Vocabulary:
    """What the driver knows of the vocabulary: sizes only."""

    tokens: int              # N: training tokens with their ends
    types: int               # V: distinct ones
    log_share: np.ndarray    # bias: log of each class's share
    tokens_of: np.ndarray    # tokens of each class
    spread: np.ndarray       # of each topic's lowest band: words seen once and unseen


def _sum_stats(batches):
    """The shards' sizes that came with the buckets of a task, summed."""
    total = np.zeros(4 * END)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            total += np.frombuffer(raw, np.float64).reshape(-1, 4 * END).sum(axis=0)
    yield pa.record_batch({"s": pa.array([total.tobytes()], pa.binary())})


def _vocabulary(stats: np.ndarray, n_train: int) -> Vocabulary:
    stats = stats.reshape(4, END) if stats.size else np.zeros((4, END))
    sizes = np.append(stats[0], n_train)
    once, twice = (stats[i].reshape(TOPICS, BANDS).sum(axis=1) for i in (2, 3))
    unseen = once * np.maximum(once - 1, 0) / (2 * (twice + 1)) + 1
    share = (sizes + 0.5) / (sizes.sum() + 0.5 * CLASSES)
    return Vocabulary(int(sizes.sum()), int(stats[1].sum()) + (n_train > 0), np.log(share), sizes, once + unseen)


UNKNOWN = CLASSES                          # the code of a word that training never saw; as context, as START + 1 would be

_CODED = "b int, rows binary, coded binary, stats binary"
_CODED_SCHEMA = pa.schema([("b", pa.int32()), ("rows", pa.binary()), ("coded", pa.binary()), ("stats", pa.binary())])


def _encode(shards: int):
    """Bucket: its tokens as class codes and hashed words, and its documents with their sums of log counts.

    Three bytes a token, packed: later passes neither tokenise nor shuffle.
    """
    def run(table: pa.Table, reply: pa.Table) -> pa.Table:
        got = {r["shard"]: r for r in reply.to_pylist()}
        stats = b"".join(r["stats"] for r in got.values() if r["stats"]) or None
        if not len(table):
            return pa.Table.from_pylist([], schema=_CODED_SCHEMA)
        t = Tokens(table["text"])
        words, inverse = np.unique(t.word, return_inverse=True)
        order, which, at = _by_shard(words, shards)
        count, topic = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for s, x, y in zip(which, at[:-1], at[1:]):
            count[order[x:y]] = np.frombuffer(got[int(s)]["count"], np.int64)
            topic[order[x:y]] = np.frombuffer(got[int(s)]["topic"], np.uint8)
        n_docs = len(t.off) - 1
        end = t.off[1:] + np.arange(n_docs)                   # places of the end tokens
        word = np.ones(len(t.word) + n_docs, bool)
        word[end] = False
        code = np.full(len(word), END, np.uint8)
        code[word] = np.where(count > 0, topic * BANDS + band_of(count), UNKNOWN).astype(np.uint8)[inverse]
        hashed = np.zeros(len(word), np.uint16)
        hashed[word] = (_mix(words + np.uint64(5)) % np.uint64(WORD_FEATURES)).astype(np.uint16)[inverse]
        known = np.bincount(t.doc, count[inverse] > 0, n_docs)
        plus_one = np.bincount(t.doc, np.log(count + 1.0)[inverse], n_docs)
        above = np.bincount(t.doc, np.log(np.maximum(count, 1.0))[inverse], n_docs)   # words seen once add nothing
        docs = pa.table({
            "doc_id": table["doc_id"], "held": table["held"], "n": np.diff(t.off) + 1, "known": known.astype(np.int64),
            "plus_one": plus_one, "above": above})
        return pa.Table.from_pylist([{
            "b": table["b"][0].as_py(), "rows": _to_ipc(docs), "stats": stats,
            "coded": zlib.compress(code.tobytes() + hashed.tobytes(), 1)}], schema=_CODED_SCHEMA)
    return run


def _to_ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


class Encoded:
    """A bucket's tokens read back: class codes, features, and its documents."""

    def __init__(self, row: dict):
        self.docs = pa.ipc.open_stream(row["rows"]).read_all()
        sizes = self.docs["n"].to_numpy()
        raw = zlib.decompress(row["coded"])
        n = int(sizes.sum())
        self.cls = np.frombuffer(raw[:n], np.uint8).astype(np.int64)
        hashed = np.frombuffer(raw[n:], np.uint16).astype(np.int64)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        context = np.where(self.cls == UNKNOWN, END, self.cls)   # END is no context: it stands for a word without a topic

        def back(x, k, none):
            out = np.full(n, none)
            out[k:] = x[:max(0, n - k)]
            out[place < k] = none
            return out
        c = [back(context, k, START) for k in (1, 2, 3, 4)]
        self.features = np.stack([
            back(hashed, 1, 0), WORD_FEATURES + back(hashed, 2, 0),
            2 * WORD_FEATURES + c[0] * (CLASSES + 1) + c[1], 2 * WORD_FEATURES + PAIRS + c[2] * (CLASSES + 1) + c[3]], axis=1)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def _logits(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    z = weights[features[:, 0]]
    for j in range(1, features.shape[1]):
        z += weights[features[:, j]]
    return z + bias


def _train(weights_of, v: Vocabulary, rate: float = 0.5):
    """AdaGrad steps over the training tokens of each bucket; yields tokens * weights, and tokens, summed over a task's buckets."""
    def run(batches):
        total = np.zeros(FEATURES * CLASSES + 1)
        start = weights_of.value.astype(np.float32)
        bias = v.log_share.astype(np.float32)
        for batch in batches:
            for i in range(batch.num_rows):
                e = Encoded(batch.slice(i, 1).to_pylist()[0])
                # a training word is known; only words of held-out documents are not
                mine = ~e.docs["held"].to_numpy(zero_copy_only=False)[e.doc]
                features, cls = e.features[mine], e.cls[mine]
                if not len(cls):
                    continue
                w = start.copy()
                seen = np.full(w.shape, 1e-4, np.float32)
                for lo in range(0, len(cls), BATCH):
                    f, y = features[lo:lo + BATCH], cls[lo:lo + BATCH]
                    r = np.exp(_log_softmax(_logits(w, bias, f)))
                    r[np.arange(len(y)), y] -= 1
                    g = np.empty_like(w)
                    flat = f.T.reshape(-1)
                    for k in range(CLASSES):
                        g[:, k] = np.bincount(flat, np.tile(r[:, k], f.shape[1]), FEATURES)
                    g /= np.sqrt(len(y))
                    seen += g * g
                    w -= rate * g / np.sqrt(seen)
                total[:-1] += w.reshape(-1) * (len(cls) / 1e6)
                total[-1] += len(cls) / 1e6
        yield pa.record_batch({"s": pa.array([total.astype(np.float32).tobytes()], pa.binary())})
    return run


_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _score(weights_of, v: Vocabulary, n_train: int):
    def run(batches):
        w, bias = weights_of.value.astype(np.float32), v.log_share.astype(np.float32)
        lowest = np.arange(TOPICS) * BANDS
        with np.errstate(divide="ignore"):
            inside = -np.log(np.append(v.tokens_of, 1.0))       # of a class; a word's own log count is in its document's sum
        inside[lowest], inside[END], inside[UNKNOWN] = -np.log(v.spread), 0.0, 0.0
        for batch in batches:
            for i in range(batch.num_rows):
                e = Encoded(batch.slice(i, 1).to_pylist()[0])
                n = len(e.docs)
                score = e.docs["above"].to_numpy().copy()
                for lo in range(0, len(e.cls), BATCH):
                    y = e.cls[lo:lo + BATCH]
                    z = _log_softmax(_logits(w, bias, e.features[lo:lo + BATCH])).astype(np.float64)
                    p = z[np.arange(len(y)), np.minimum(y, END)] + inside[y]
                    new = np.flatnonzero(y == UNKNOWN)
                    p[new] = np.log((np.exp(z[new][:, lowest]) / v.spread).sum(axis=1))
                    score += np.bincount(e.doc[lo:lo + BATCH], p, n)
                size = e.docs["n"].to_numpy()
                base = (e.docs["plus_one"].to_numpy() + np.log(n_train + 1.0) - size * np.log(v.tokens + v.types + 1.0)) / LOG10
                yield pa.record_batch({
                    "doc_id": e.docs["doc_id"].combine_chunks(), "held_out": e.docs["held"].combine_chunks(), "n_tokens": pa.array(size, pa.int64()),
                    "n_known": pa.array(e.docs["known"].to_numpy() + (n_train > 0), pa.int64()),
                    "train_tokens": pa.array(np.full(n, v.tokens), pa.int64()), "base_score": pa.array(base, pa.float64()),
                    "score": pa.array(score / LOG10 if v.tokens else base, pa.float64())})
    return run


def score_documents(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row; reads doc_id and text only."""
    spark = docs.sparkSession
    total = text_bytes(docs)
    buckets, shards = parts_for(total, BUCKET_BYTES), parts_for(total, SHARD_BYTES)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), (id_crc() % folds == held_out).alias("held"))
    n_train = base.where(~F.col("held")).count()
    centres = fit_topics(base.where(~F.col("held")), buckets)
    base = base.withColumn("b", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int"))
    asked = base.groupBy("b").applyInArrow(_ask(centres, shards), "shard int, b int, words binary, at binary, topic binary, n binary")
    answers = asked.groupBy("shard").applyInArrow(_answer, "b int, shard int, count binary, topic binary, stats binary")
    coded = checkpoint(base.groupBy("b").cogroup(answers.groupBy("b")).applyInArrow(_encode(shards), _CODED))
    found = coded.where("stats is not null").select(F.col("stats").alias("s")).mapInArrow(_sum_stats, "s binary")
    v = _vocabulary(_tree_sum(found, np.float64, buckets), n_train)
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    for _ in range(rounds if v.tokens else 0):
        shared = spark.sparkContext.broadcast(weights.astype(np.float16))     # FEATURES x CLASSES, whatever the data
        mean = _tree_sum(coded.select("rows", "coded").mapInArrow(_train(shared, v), "s binary"), np.float32, buckets)
        weights = (mean[:-1] / mean[-1]).reshape(weights.shape)
    shared = spark.sparkContext.broadcast(weights.astype(np.float16))
    return coded.select("rows", "coded").mapInArrow(_score(shared, v, n_train), _SCORED)
