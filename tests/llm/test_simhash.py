"""Operator 3 against brute force."""

import random

import pytest
import xxhash

from kalulu.llm import simhash_dedup as S
from kalulu.llm.components import connected_components


def brute_fp(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits):
    ids = list(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if bin(fps[a] ^ fps[b]).count("1") <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_texts(spark):
    rnd = random.Random(1)
    words = [f"W{i}" for i in range(200)]
    texts = ["", None, " \n", "one", "Two words", "É É é"]
    for _ in range(25):
        t = rnd.choices(words, k=rnd.randint(1, 120))
        texts.append(" ".join(t))
        for _ in range(3):
            u = list(t)
            u[rnd.randrange(len(u))] = "Z"
            texts.append("\t".join(u))
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, fp string")
    fps = {i: brute_fp(t) for i, t in enumerate(texts)}
    comp = brute_components(fps, 2)
    got = S.simhash_components(df).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", comp[r.doc_id])
    kept = {r.doc_id for r in S.one_of_each(df).collect()}
    assert kept == set(comp.values())


@pytest.mark.parametrize("small,bits", [(32, 2), (2, 2), (32, 1), (2, 1), (2, 0)])
def test_links_lose_nothing(spark, monkeypatch, small, bits):
    monkeypatch.setattr(S, "SMALL", small)
    rnd = random.Random(small)
    fps = []
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(25):
            fps.append(x)
            x ^= sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, 1, 2, 2, 3, 4])))
    fps += [0, 1, 3, 2 ** 64 - 1, 2 ** 63, 2 ** 63 + 1]
    ids = dict(enumerate(fps))
    signed = [(i, v - 2 ** 64 if v >= 2 ** 63 else v) for i, v in ids.items()]
    got = {r.doc_id: r.component_id for r in S.components_of(spark.createDataFrame(signed, "doc_id bigint, fp bigint"), bits).collect()}
    assert got == brute_components(ids, bits)


def test_components_and_empty(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    seen = {}
    for a, b in edges:
        for x in (a, b):
            seen.setdefault(x, {x})
    for a, b in edges:
        if seen[a] is not seen[b]:
            u = seen[a] | seen[b]
            for x in u:
                seen[x] = u
    assert got == {x: min(s) for x, s in seen.items() if len(s) > 1}
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.simhash_components(none).collect() == [] and S.one_of_each(none).collect() == []


def test_null_ids_and_repeats(spark):
    df = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "zz yy xx ww")], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.component_id) for r in S.simhash_components(df).collect()), key=str)
    assert got == sorted([(None, 4), (4, 4), (4, 4), (None, None)], key=str)


def test_one_row_of_each(spark):
    a, b, c = "a b c d e f", "zz yy xx ww vv", "one two three four five six"
    rows = [(None, a, "1"), (None, a, "2"),                        # no other id: one of the two
            (None, b, "3"), (5, b, "4"), (4, b, "5"),              # null never before an id
            (4, c, "6"), (3, c, "7"), (3, c, "7"), (3, c, "8")]    # 4 is smallest elsewhere, repeated rows count once
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    kept = S.one_of_each(df)
    got = {r.text: (r.doc_id, r.fp) for r in kept.collect()}
    assert kept.columns == df.columns and kept.count() == 3
    assert got[a][0] is None and got[b] == (4, "5") and got[c][0] == 3
