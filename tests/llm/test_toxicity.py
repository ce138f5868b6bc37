"""Operator 4: the grammar, what it learns, and held-out accuracy."""

import random

import numpy as np
import pytest

from kalulu.llm import toxicity as T

DOCS = "doc_id bigint, text string, lang string, score string"


def kinds(text, insults=("idiot", "scum")):
    return dict(T.Grammar({w.encode() for w in insults}).kinds(text))


def test_composed_transducers():
    assert kinds("what an idiot") == {"I": 1}
    assert kinds("You are an Idiot!") == {"I@": 1}
    assert kinds("you are not an idiot") == {"I-@": 1}
    assert kinds("she said you idiot") == {'I"@': 1}
    assert kinds("he said they are not idiot") == {'I-"@': 1}
    assert kinds("said. idiot") == {"I": 1}                     # clauses stand alone
    assert kinds("you a b c d idiot") == {"I": 1}               # out of reach
    assert kinds("idiot, idiot; you scum\nkill you") == {"I": 2, "I@": 1, "T": 1}
    assert kinds("") == kinds(None) == kinds("...") == {}
    g = T.Grammar({b"idiot"})
    assert g.score("you idiot") > g.score("idiot") > g.score("not an idiot") > g.score("") == g.score(None)
    assert g.score("x " * 100000 + "idiot " * 50000) <= 1.0


def labelled(n, seed=0):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic = rnd.random() < .2
        t = rnd.choices(words, k=rnd.randint(0, 60))
        for _ in range(rnd.randint(1, 4) if toxic else 0):
            t.insert(rnd.randint(0, len(t)), rnd.choice(["idiot", "grumbolt", "snark,"]))
        docs.append((i, " ".join(t), "en", "x"))
        labels.append((i, int(toxic)))
    return docs, labels


def test_learns_words_and_generalises(spark):
    docs, labels = labelled(1500)
    labels += [(3, None), (None, 1), (99999, 1)]
    df = spark.createDataFrame(docs + [(None, "idiot", None, None), (7, None, None, None)], DOCS)
    g = T.learn(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert {b"grumbolt", b"snark", b"idiot"} <= g.loaded and not any(w.startswith(b"w1") for w in g.loaded)
    rows = T.score_documents(df, g).collect()
    assert len(rows) == len(docs) + 2
    truth = dict((i, y) for i, y in labels if y is not None)
    import zlib
    held = [(r.score, truth[r.doc_id]) for r in rows if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = np.mean([(s >= .5) == bool(y) for s, y in held])
    assert right > 0.98
    kept = T.accept(df, g)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i, y in truth.items() if y == 0 and i < 1500}


def test_held_out_labels_are_not_read(spark):
    import zlib
    docs, labels = labelled(600, 2)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    df = spark.createDataFrame(docs, DOCS)
    a, b = (T.learn(df, spark.createDataFrame(x, "doc_id bigint, toxic int")) for x in (labels, flipped))
    assert a.symbols == b.symbols and np.allclose(a.weights, b.weights)


@pytest.mark.parametrize("labels", [[], [(0, 0)], [(1, 1)]])
def test_without_labels(spark, labels):
    df = spark.createDataFrame([(0, "fine", "", ""), (1, "you idiot", "", "")], DOCS)
    g = T.learn(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert {r.doc_id: r.score >= .5 for r in T.score_documents(df, g).collect()} == {0: False, 1: True}
    assert T.score_documents(df.where("false"), g).collect() == [] and T.accept(df.where("false"), g).collect() == []


def test_texts_that_begin_alike_are_all_learned_from(spark):
    import zlib
    head = "This page is part of the archive of letters to the editor of the paper: "
    docs, labels = labelled(1500, 3)
    docs = [(i, head + t, a, b) for i, t, a, b in docs]
    g = T.learn(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert {b"grumbolt", b"snark"} <= g.loaded
    # copies count once, by the share of their labels: neither the many clean copies nor the one toxic one decide
    docs, labels = labelled(1500, 3)
    free = [i for i in range(5000, 6000) if zlib.crc32(str(i).encode()) % 5]
    docs += [(i, "plainword here", "en", "x") for i in free]
    labels += [(i, int(i == free[0])) for i in free]
    sample = T._labelled_sample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int"), T.FOLDS)
    (row,) = sample.where("text = 'plainword here'").collect()
    assert abs(row.toxic - 1 / len(free)) < 1e-9
