"""The pipeline, stage by stage, against plain Python on the rows that each stage got."""

import pytest

import corpus_pipeline as P
from kalulu.llm import decontamination, mixing, toxicity
from tests.llm.test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


def brute_cut(rows, n):
    """doc_id -> kept text; ids differ."""
    seen, out = set(), {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        x = (r.text or "").encode()
        gone = bytearray(len(x))
        for i in range(len(x) - n + 1):
            key = x[i:i + n]
            if key in seen:
                gone[i:i + n] = b"\x01" * n
            seen.add(key)
        out[r.doc_id] = bytes(c for c, g in zip(x, gone) if not g).decode("utf-8", "ignore")
    return out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("stages"))
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for i, (name, f) in enumerate(P.STAGES):
        f(spark, out[-1], SF).write.parquet(f"{d}/{i}")
        out.append(spark.read.parquet(f"{d}/{i}"))
    return [(x.columns, x.collect()) for x in out]


def test_columns(stages):
    for cols, _ in stages[:-1]:
        assert cols == stages[0][0]
    assert stages[-1][0] == [*stages[0][0], "copy", "shuffle_key"]


def test_toxicity(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    g = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in stages[1][1]} == {r.doc_id for r in stages[0][1] if g.score(r.text) < 0.5}


def test_near_copies(stages):
    comp = brute_components({r.doc_id: brute_fp(r.text) for r in stages[1][1]}, 2)
    assert sorted(r.doc_id for r in stages[2][1]) == sorted(set(comp.values()))


def test_repeats(stages):
    assert {r.doc_id: r.text for r in stages[3][1]} == brute_cut(stages[2][1], 100)
    assert all(r.n_chars == len(r.text) for r in stages[3][1])


def test_contamination(spark, stages):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    held = set()
    for r in stages[3][1]:
        words = decontamination.words_of(r.text)
        grams = {n: {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} for n in range(1, 6)}
        for it in items:
            q, a = decontamination.question_and_answer(it.text)
            ok = True
            for part in (q, a):
                n = min(5, len(part))
                want = {tuple(part[i:i + n]) for i in range(len(part) - n + 1)} if n else set()
                ok &= not want or len(want & grams[n]) / len(want) >= 0.8
            if ok:
                held.add(r.doc_id)
    assert {r.doc_id for r in stages[4][1]} == {r.doc_id for r in stages[3][1]} - held


def test_mixing_and_run(spark, stages):
    import duckdb
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", [tuple(r) for r in stages[4][1]])
    want = sorted(con.execute(mixing.mix_sql()).fetchall(), key=str)
    assert sorted(map(tuple, stages[5][1]), key=str) == want
    assert sorted(map(tuple, P.run(spark, SF).collect()), key=str) == want


def test_odd_rows(spark, tmp_path):
    s = "doc_id bigint, text string, lang string, source string, n_chars bigint, copy string, _kept int, b int, fp int"
    rows = [(None, None, None, None, None, "x", 1, 1, 1), (1, "", "en", "a", 0, None, 1, 1, 1), (2, "word " * 3000, "en", "a", 1, None, 1, 1, 1),
            (2, "word " * 3000, "en", "a", 1, None, 1, 1, 1), (3, "You idiot, you scum. Idiot!", "en", "b", 1, None, 1, 1, 1), (4, "fine text here", None, None, 1, None, 1, 1, 1)]
    spark.createDataFrame([], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "what is it? nothing"), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (rows, []):
        docs = spark.createDataFrame(table, s)
        for name, f in P.STAGES:
            docs = f(spark, docs, str(tmp_path))
            assert {"doc_id", "text", "lang", "source", "n_chars", "_kept", "b", "fp"} <= set(docs.columns), name
            docs = docs.checkpoint()
            if name == "toxicity" and table:
                assert {r.doc_id for r in docs.collect()} == {None, 1, 2, 4}
        assert (docs.count() > 0) or not table
