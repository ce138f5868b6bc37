"""Operator 12 against its SQL, plain integers and odd rows."""

import duckdb
import numpy as np
import pytest

from kalulu.llm import source_audit as S

COLS = "doc_id bigint, text string, lang string, source string, term string, n bigint"


def plain_f(p, q):
    return (p - q) * (p - q) // (p + q)


def rows():
    rng = np.random.default_rng(7)
    words = ["Ab", "b", "ça", "Ça", "d'e", "zz9zz", "éé", "q" * 40, "x_y"] + [f"w{chr(97 + i)}" for i in range(20)]
    out = []
    for i in range(260):
        lang = ["en", "fr", None, "solo"][min(3, int(rng.integers(0, 40)) // 13)]
        picked = rng.choice(words, int(rng.integers(0, 40)), p=np.arange(len(words), 0, -1) / sum(range(len(words) + 1)))
        source = "hot" if i % 3 == 0 else [None, "s1", "s2", "Ä"][i % 4]
        out.append((i, " ".join(picked), lang, "one" if lang == "solo" else source, "clash", 1))
    return out + [(5, "ab ab", "en", "s1", "", 2), (5, "ab ab", "en", "s1", "", 2), (None, None, "en", "nothing", None, None),
                  (900, "", "few", "a", "", 0), (901, "rare word", "few", "b", "", 0)]


def by_sql(data, **kw):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", [r[:4] for r in data])
    return sorted(con.execute(S.audit_sql(**kw)).fetchall())


@pytest.mark.parametrize("least", [10, 1])
def test_against_sql(spark, least):
    data = rows()
    got = S.audit(spark.createDataFrame(data, COLS), min_docs=least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    want = by_sql(data, min_docs=least)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 60
    if least == 10:
        few = [r for r in want if r[0] == "few"]
        assert few == [("few", "a", "pair", "b", 0, 1), ("few", "b", "pair", "a", 0, 1)]      # no kept term: 0
        assert any(r[1] == "nothing" and r[4] > 0 for r in want)                              # a group without terms


def test_joint_tables_count_every_pair_of_levels(monkeypatch):
    rng = np.random.default_rng(1)
    counts = rng.poisson(1.5, (300, 5)).astype(np.int64)
    counts[:40] *= np.arange(1, 41)[:, None] * 1000           # rows whose levels are all their own
    want = {}
    for row in counts.tolist():
        for a in range(5):
            for b in range(a + 1, 5):
                want[a, row[a], b, row[b]] = want.get((a, row[a], b, row[b]), 0) + 1
    for limit in (2048, 16, 3):                               # blocks are halved, then panels are cut
        monkeypatch.setattr(S, "MAX_COLUMNS", limit)
        got = {}
        for part in S.joint_tables(counts):
            for a, x, b, y, n in zip(*(c.tolist() for c in part)):
                got[a, x, b, y] = got.get((a, x, b, y), 0) + n
        assert got == want


def test_prices_are_exact_at_any_size():
    big = np.array([[3, 9_999_999_999_999], [0, 12], [7 * 10 ** 12, 1]], np.int64)
    totals, terms = [int(x) for x in big.sum(axis=0)], 3
    p = [[1 + S.UNIT * (int(c) + 2) // (totals[g] + 2 * terms) for g, c in enumerate(row)] for row in big]
    assert S.price_block(big, totals, terms)[0, 1] == sum(plain_f(a, b) for a, b in p)


def test_blocks_of_a_group_and_odd_tables(spark, monkeypatch):
    data = rows()
    monkeypatch.setattr(S, "BLOCK_CELLS", 24)                 # several blocks a level
    monkeypatch.setattr(S, "FLUSH_TERMS", 5)
    monkeypatch.setattr(S, "PIECE", 16)                       # long texts are split in pieces
    got = S.audit(spark.createDataFrame(data, COLS), min_docs=2, top=3)
    assert sorted(tuple(r) for r in got.collect()) == by_sql(data, min_docs=2, top=3)
    assert S.audit(spark.createDataFrame([], COLS)).collect() == []
    long = [(1, "word other " * 200_000, "en", "a", "", 0), (2, "x" * 300_000, "en", "b", "", 0)]
    out = {(r.source, r.item): r.value for r in S.audit(spark.createDataFrame(long, COLS), min_docs=1).collect() if r.part == "pair"}
    assert out["a", "b"] == out["b", "a"] > 0
