"""Operator 1: exact counts and base, and the model against it on held-out texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from kalulu.llm import lm_scoring as L

S = "doc_id bigint, text string, score string"


def brute(rows):
    held = {i: zlib.crc32((str(i) if i is not None else "").encode()) % 7 == 2 for i, _ in rows}
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    tokens = lambda t: (t or "").encode().translate(low).split() + [None]
    c = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return sorted(((i, held[i], len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows), key=str)


def shown(got):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str)


def corpus(seed, n):
    """Two languages with an order of words: what a model with context can learn."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.random() < .3
        vocab = [("Zz" if lang else "aÄ") + str(k) for k in range(60)]
        w, at = [], rnd.randrange(60)
        for _ in range(rnd.randint(0, 60)):
            w.append(vocab[at] if rnd.random() < .95 else f"new{rnd.random()}")
            at = min(59, int(rnd.expovariate(.1)))
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("bucket", [None, 2000])
def test_against_brute_force(spark, monkeypatch, bucket):
    if bucket:
        monkeypatch.setattr(L, "BUCKET_BYTES", bucket)
        monkeypatch.setattr(L, "SHARD_BYTES", 3000)
    rows = corpus(1, 300) + [(None, "Odd one"), (1000, None), (1001, ""), (1002, " \n"), (1003, "long " * 3000), (5, "again"), (5, "again")]
    got = L.score_documents(spark.createDataFrame([(*r, "x") for r in rows], S)).collect()
    assert shown(got) == brute(rows)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)


def test_probabilities_sum_to_one():
    v = L._vocabulary(np.concatenate([np.arange(L.END) * 7.0 + 5, np.ones(L.END), np.tile([3, 0, 0, 0, 0], L.TOPICS) * 1.0, np.ones(L.END)]), 40)
    rnd = np.random.default_rng(0)
    w = rnd.normal(size=(L.FEATURES, L.CLASSES)).astype(np.float32)
    z = L._log_softmax(L._logits(w, v.log_share.astype(np.float32), rnd.integers(0, L.FEATURES, (50, 4))))
    assert np.exp(z).sum(axis=1) == pytest.approx(1, abs=1e-5)


def test_no_training_and_empty(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = L.score_documents(spark.createDataFrame([(held, "a b", "")], S)).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(True, 3, 0, 0, 0.0, 0.0)]
    assert L.score_documents(spark.createDataFrame([], S)).collect() == []
