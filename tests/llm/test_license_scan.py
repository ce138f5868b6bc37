"""Operator 9: held-out accuracy, templates, and odd inputs."""

import random

import numpy as np
import pytest

from kalulu.llm import license_scan as L

S = "doc_id bigint, text string, family string"


def prose(rnd, n):
    return " ".join("".join(rnd.choices(["th", "er", "on", "an", "re", "ing", "tion"], k=rnd.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(1)
    return L.fit([prose(rnd, rnd.randint(1, 70)) for _ in range(1500)])


def test_finds_the_families(spark, model):
    rnd = random.Random(2)
    rows, want = [], set()
    for i, (f, ts) in enumerate(L.TEMPLATES.items()):
        for j, t in enumerate(ts):
            d = 100 * i + j
            rows.append((d, prose(rnd, 200) + "\n\n" + t.upper() + "\n" + prose(rnd, 30), "x"))
            want.add((d, 2, f))
    rows += [(90_000 + i, "\n".join(prose(rnd, rnd.randint(0, 80)) for _ in range(20)), "x") for i in range(60)]
    rows += [(95_000, " \n".join(L.OTHER_USES), "x"), (None, "Released under the MIT License.", None), (95_001, None, None), (95_002, "", None)]
    rows += [(95_003, prose(rnd, 5000) + " Licensed under the Apache License, Version 2.0. " + prose(rnd, 5000), None)]
    got = L.scan(spark.createDataFrame(rows, S), model).collect()
    named = {(r.doc_id, r.line, r.family) for r in got if r.confirmed}
    assert len(want & named) >= 0.95 * len(want)
    assert {(None, 0, "MIT"), (95_003, 0, "Apache-2.0")} <= named
    assert not {r.doc_id for r in got if r.doc_id and 90_000 <= r.doc_id <= 95_002 and r.confirmed}
    assert sum(1 for r in got if r.doc_id and 90_000 <= r.doc_id <= 95_002) <= 2


def test_window_sums_are_those_of_brute_force(model):
    rnd = random.Random(3)
    texts = [prose(rnd, n) for n in (0, 1, 2, 3, 59, 60, 61, 90, 91, 500)] + ["a\nb c\n\nd e f", "by " * 50 + "MIT License"]
    p = L.Paragraphs(*L.flat_bytes(L.pa.array(texts)))
    g = p.grams(model.known)
    sums = p.sums(model.known, model.weights, p.lo, p.hi)
    for i, (lo, hi) in enumerate(zip(p.lo, p.hi)):
        held = {g[n][j] for n in range(min(3, len(g))) for j in range(lo, hi - n)} - {len(model.known)}
        want = sum((model.weights[j].astype(float) for j in held), np.zeros(len(L.FAMILIES)))
        assert sums[i] == pytest.approx(want, abs=1e-4)
    assert [(int(d), int(n), p.text(i)) for i, (d, n) in enumerate(zip(p.doc, p.line))][-4:-1] == [(10, 0, "a"), (10, 1, "b c"), (10, 3, "d e f")]


def test_empty_and_sample(spark, model):
    df = spark.createDataFrame([(1, "a\nb\n\na", ""), (2, None, ""), (3, "c", "")], S)
    assert sorted(L.sample_lines(df)) == ["a", "b", "c"]
    assert L.scan(df.where("false"), model).collect() == [] and L.sample_lines(df.where("false")) == []
    assert L.fit([]).weights.shape[1] == len(L.FAMILIES)


def test_wrapped_notices(spark, model):
    import textwrap
    rnd = random.Random(4)
    rows, want = [], set()
    for i, (f, ts) in enumerate(L.TEMPLATES.items()):
        for j, t in enumerate(ts):
            d = 100 * i + j
            lines = textwrap.wrap(t, 72)
            around = textwrap.wrap(prose(rnd, 40), 72)
            if d % 2:                                             # the notice is a paragraph of its own, or inside one
                rows.append((d, "\n".join([*around, "", *lines, " ", *around]), None))
                want.add((d, len(around) + 1, f))
            else:
                rows.append((d, "\n".join([*around, *lines, *around]), None))
                want.add((d, len(around), f))
    rows += [(90_000 + i, "\n".join(textwrap.wrap(prose(rnd, 400), 72)), None) for i in range(30)]
    got = L.scan(spark.createDataFrame(rows, S), model).collect()
    named = {(r.doc_id, r.line, r.family) for r in got if r.confirmed}
    assert len(want & named) >= 0.95 * len(want)
    assert not [r for r in got if r.doc_id >= 90_000 and r.confirmed]
    long_ = [(100 * i + j, f) for i, (f, ts) in enumerate(L.TEMPLATES.items()) for j, t in enumerate(ts) if len(t) > 100]
    assert len(long_) >= 8 and set(long_) <= {(d, f) for d, _, f in named}
    assert len({(r.doc_id, r.line, r.family) for r in got}) == len(got)
    # twice in one window: each is found
    t = textwrap.wrap(L.TEMPLATES["MIT"][4], 72)
    twice = L.scan(spark.createDataFrame([(1, "\n".join([*t, *t]), None)], S), model).collect()
    assert {(r.line, r.family) for r in twice if r.confirmed} == {(0, "MIT"), (len(t), "MIT")} and all(r.confirmed for r in twice)


def test_sample_holds_distinct_lines_however_often_one_repeats(spark):
    from pyspark.sql import functions as F
    from kalulu.llm.license_scan import SAMPLE_CHARS, sample_lines
    lines = spark.range(3000).select(F.concat(F.lit("line number "), F.col("id")).alias("text"))
    alone = sample_lines(lines)
    assert len(alone) == len(set(alone)) == 3000
    for hot in (alone[0], alone[-1]):
        assert sample_lines(lines.unionByName(spark.range(20_000).select(F.lit(hot).alias("text")))) == alone
    assert sample_lines(lines, most=100) == alone[:100]
    head = "a " * SAMPLE_CHARS
    long = spark.createDataFrame([(f"{head}tail{i} " * 3,) for i in range(40)], "text string")
    assert any("tail" in x for x in sample_lines(long)) and max(map(len, sample_lines(long))) <= SAMPLE_CHARS
