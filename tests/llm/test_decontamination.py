"""Operator 5 against scoring every passage with every item."""

import math
import random
from collections import Counter

import pytest

from kalulu.llm import decontamination as D

SCHEMA = "doc_id bigint, text string, score string"


def make(seed, n_items=40, n_docs=80):
    rnd = random.Random(seed)
    common = [f"c{i}" for i in range(15)]
    words = [f"w{i}" for i in range(400)]

    def prose(n):
        return " ".join(rnd.choice(common) if rnd.random() < .5 else rnd.choice(words) for _ in range(n))
    items = [(i, f"{prose(rnd.randint(8, 40))}. {prose(rnd.randint(3, 9))}?") for i in range(n_items)]
    items += [(900, prose(150) + ". " + prose(10)), (901, ""), (902, None), (903, "Single words only here now"), (904, items[0][1])]
    docs = []
    for d in range(n_docs):
        t = prose(rnd.randint(0, 700))
        if d % 3 == 0:
            item = rnd.choice(items)[1] or ""
            t = prose(rnd.randint(0, 300)) + " " + item.upper() + " " + t
        if d % 10 == 1:      # the question without its answer
            t += " " + items[d % n_items][1].split(".")[0]
        docs.append((d, t, None))
    return items, docs + [(5000, None, "x"), (5001, "", "x"),
                           (6000, prose(90) + " " + items[n_items][1] + " " + prose(50), None)]


def brute(items, docs, threshold, overlap):
    words = {i: D.words_of(t) for i, t in items if D.words_of(t)}
    text = dict(items)
    df = Counter(t for w in words.values() for t in set(w))
    mean = sum(map(len, words.values())) / len(words)
    out = set()
    for i, w in words.items():
        k = max(6, math.ceil(math.log2(len(w))))
        size = 2 << k
        tf = Counter(w)
        imp = {t: math.log(1 + (len(words) - df[t] + .5) / (df[t] + .5)) * n * 2.2 / (n + 1.2 * (.25 + .75 * len(w) / mean)) for t, n in tf.items()}
        q, a = D.question_and_answer(text[i])
        for d, t, _ in docs:
            dw = D.words_of(t)
            for s in range(0, max(1, len(dw)), size // 2):
                p = dw[s:s + size]
                if sum(x for t, x in imp.items() if t in set(p)) / sum(imp.values()) < threshold - 1e-9:
                    continue
                ok = True
                for part in (q, a):
                    n = min(5, len(part))
                    have = {tuple(p[j:j + n]) for j in range(len(p) - n + 1)}
                    want = {tuple(part[j:j + n]) for j in range(len(part) - n + 1)}
                    ok &= not want or len(want & have) / len(want) >= overlap
                if ok:
                    out.add((d, i))
    return out


@pytest.mark.parametrize("threshold,overlap,size", [(0.6, 0.8, None), (0.3, 0.0, 600), (0.45, 0.3, None)])
def test_against_all_pairs(spark, monkeypatch, threshold, overlap, size):
    if size:
        monkeypatch.setattr(D, "INDEX_BYTES", size)
    items, docs = make(int(threshold * 100))
    got = D.contaminated(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id bigint, text string"), threshold, overlap).collect()
    pairs = [(r.doc_id, r.item_id) for r in got]
    assert len(pairs) == len(set(pairs)) and set(pairs) == brute(items, docs, threshold, overlap)
    assert (6000, 900) in pairs


def test_edges(spark):
    items = spark.createDataFrame([(1, "What is the name of the tall tower? It is Eiffel")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "so: what is the NAME of the tall tower, it is Eiffel!", "a"), (2, "what is the name of the tall tower", "b"),
                                  (None, "What is the name of the tall tower? It is Eiffel", None), (3, None, None), (4, "clean", None)], SCHEMA)
    assert {r.doc_id for r in D.contaminated(docs, items).collect()} == {1, None}
    kept = D.clean_documents(docs, items)
    assert {r.doc_id for r in kept.collect()} == {2, 3, 4} and kept.columns == docs.columns
    none = items.where("false")
    assert D.contaminated(docs, none).collect() == [] and D.clean_documents(docs, none).count() == 5
    assert D.contaminated(docs.where("false"), items).collect() == []


def test_rows_are_judged_by_their_own_text(spark):
    item = "What is the name of the tall tower? It is Eiffel"
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = spark.createDataFrame([(None, item, "a"), (None, "clean one", "b"), (None, None, "c"), (7, item, "d"), (7, "clean two", "e"),
                                  (7, item, "f"), (8, "clean one", "g"), (9, item, "h")], SCHEMA)
    kept = D.clean_documents(docs, items)
    assert kept.columns == docs.columns and sorted(r.score for r in kept.collect()) == ["b", "c", "e", "g"]
