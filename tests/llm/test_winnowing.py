"""Operator 6 against brute force and the match guarantee."""

import random

import pytest
from pyspark.sql import functions as F

from kalulu.llm import winnowing as W

M = W.MODULUS


def brute(text, h, k=4, w=8):
    x = [h[t] for t in (text or "").encode().decode().replace("\t", " ").replace("\n", " ").split(" ") if t]
    if not x:
        return []
    if len(x) < k:
        a = len(x)
        for v in x:
            a = (a * W.BASE + v) % M
        grams = [a]
    else:
        grams = [sum(v * pow(W.BASE, k - 1 - j, M) for j, v in enumerate(x[i:i + k])) % M for i in range(len(x) - k + 1)]
    out = []
    for s in range(max(1, len(grams) - w + 1)):
        win = list(enumerate(grams[s:s + w], s))
        g = min(v for _, v in win)
        pick = (g, max(i for i, v in win if v == g))
        if not out or out[-1] != pick:
            out.append(pick)
    return out


def words_hash(spark, texts):
    words = sorted({t for x in texts for t in (x or "").replace("\t", " ").replace("\n", " ").split(" ") if t})
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.hash("w").alias("h"))
    return {r.w: r.h % M for r in df.collect()}


def make(seed, n=40):
    rnd = random.Random(seed)
    vocab = [f"v{i}é" for i in range(60)]
    return [" ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 3, 4, 5, 11, 12, 40, 200]))) for _ in range(n)] + [None, "", "a " * 300, "\n a\tb"]


def dice(a, b):
    a, b = {g for g, _ in a}, {g for g, _ in b}
    return 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))


@pytest.mark.parametrize("range_bytes,n", [(1 << 24, 40), (300, 40), (40, 60)])
def test_edits_against_brute_force(spark, monkeypatch, range_bytes, n):
    monkeypatch.setattr(W, "RANGE_BYTES", range_bytes)
    texts = make(n, n)
    ids = random.Random(1).sample(range(-50, 10 ** 6), len(texts))
    order = sorted(range(len(ids)), key=lambda i: -ids[i])
    want, all_texts = {}, list(texts)
    for p, i in enumerate(order):
        t, nxt = texts[i] or "", texts[order[(p + 1) % len(order)]] or ""
        half = len(t) // 2
        want[ids[i]] = (len(t), t[:len(t) - half] + nxt[:half], t, nxt)
        all_texts.append(want[ids[i]][1])
    h = words_hash(spark, all_texts)
    df = spark.createDataFrame([(t, i, "x") for t, i in zip(texts, ids)], "text string, doc_id bigint, fingerprint string")
    rows = W.compare_with_edits(df).collect()
    assert len(rows) == len(texts)
    show = lambda f: " ".join(f"{g:x}@{p}" for g, p in f)
    for r in rows:
        size, edited, t, nxt = want[r.doc_id]
        a, b, c = (brute(x, h) for x in (t, edited, nxt))
        assert (r.n_chars, r.edited_text, r.fingerprint, r.edited_fingerprint) == (size, edited, show(a), show(b))
        assert (r.near_edited, r.near_next) == pytest.approx((dice(a, b), dice(a, c)))


def test_guarantee_and_positions(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(1000)]
    shared = rnd.choices(vocab, k=W.GRAM + W.WINDOW - 1)
    rows = []
    for i in range(30):
        a, b = rnd.choices(vocab, k=50), rnd.choices(vocab, k=80)
        a[10:10], b[i:i] = shared, shared
        rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(F.size(F.array_intersect(W.chosen_hashes(W.winnow(F.col("a"))), W.chosen_hashes(W.winnow(F.col("b"))))).alias("n")).collect()
    assert all(r.n >= 1 for r in got)
    tie = spark.createDataFrame([("x " * 40, 1)], "text string, fingerprint int")
    picks = W.fingerprints(tie).first().fingerprint
    assert [p.position for p in picks] == list(range(7, 37))      # rightmost of each window


def test_nulls_ties_empty(spark):
    s = "doc_id bigint, text string, k int"
    df = spark.createDataFrame([(None, "a", 1), (1, "b", 1), (1, "b", 1), (1, "c d", 1)], s)
    rows = sorted((r.doc_id is None, r.edited_text) for r in W.compare_with_edits(df).collect())
    assert rows == [(False, "b"), (False, "b"), (False, "c a"[:2] + "a"), (True, "a")]
    assert W.compare_with_edits(df.where("false")).collect() == []
    one = W.compare_with_edits(df.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
