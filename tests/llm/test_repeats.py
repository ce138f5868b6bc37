"""Operators 2 and 10 against brute force."""

import random
import zlib

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from kalulu.llm import repeats
from kalulu.llm.substring_dedup import SuffixAutomaton, automaton_matcher, substring_dedup
from kalulu.llm.suffix_dedup import lpf_matcher, suffix_dedup, suffix_dedup_texts

SCHEMA = "text string, doc_id bigint, n_removed string, b int"


def rows_of(pairs):
    return [(t, d, "x", 1) for d, t in pairs]


def brute_words(docs, n):
    """docs: distinct (doc_id, text); what stays of each."""
    first = {}
    for d, t in docs:
        w = (t or "").encode().split()
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            first[key] = min(first.get(key, d), d, key=lambda x: -2 ** 63 if x is None else x)
    out = []
    for d, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            f = first[tuple(w[i:i + n])]
            if f != d and (f is None or d is not None and f < d):
                gone[i:i + n] = [True] * n
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def brute_bytes(docs, n):
    """docs in order of their ids, which differ."""
    seen, out = set(), []
    for d, t in docs:
        x = (t or "").encode()
        gone = bytearray(len(x))
        for i in range(len(x) - n + 1):
            key = x[i:i + n]
            if key in seen:
                gone[i:i + n] = b"\x01" * n
            seen.add(key)
        spans = sum(1 for i in range(len(x)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(x), sum(gone), spans, bytes(c for c, g in zip(x, gone) if not g)))
    return sorted(out, key=str)


def corpus(seed, n_docs=60):
    rnd = random.Random(seed)
    words = [rnd.choice("abcdefgäß") * rnd.randint(1, 3) + str(rnd.randint(0, 30)) for _ in range(40)]
    passages = [" ".join(rnd.choices(words, k=rnd.randint(5, 40))) for _ in range(6)]
    docs = []
    for i in range(n_docs):
        parts = []
        for _ in range(rnd.randint(0, 6)):
            parts.append(rnd.choice(passages) if rnd.random() < .5 else " ".join(rnd.choices(words, k=rnd.randint(1, 25))))
        docs.append((i * 3, rnd.choice([" ", "\n", "\t "]).join(parts)))
    docs += [(1000, docs[5][1]), (1001, docs[5][1]), (1002, ""), (1003, None), (1004, " \n"), (1005, "ab" * 400), (1006, "x " * 300)]
    return docs


@pytest.mark.parametrize("buckets", [None, 400, 900])
def test_against_brute_force(spark, monkeypatch, buckets):
    if buckets:
        monkeypatch.setattr(repeats, "BUCKET_BYTES", buckets)
        monkeypatch.setattr(repeats, "SHARD_BYTES", 3 * buckets)
    docs = corpus(buckets or 7)
    df = spark.createDataFrame(rows_of(docs), SCHEMA)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(df, 13).collect()), key=str)
    assert got == brute_words(docs, 13)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup(df, 40).collect()), key=str)
    assert got == brute_bytes(docs, 40)


def in_process(docs, spec, matcher, buckets, shards):
    """The steps of remove_repeats without Spark, so that this process's constants hold."""
    def by(table, column):
        return {k: table.filter(pa.compute.equal(table[column], k)) for k in set(table[column].to_pylist())}
    table = pa.table({
        "rest": pa.array([{"doc_id": d} for d, _ in docs]), "text": pa.array([t or "" for _, t in docs]),
        "k": pa.array([d for d, _ in docs]), "h": pa.array([zlib.crc32((t or "").encode()) for _, t in docs], pa.int64()),
        "b": pa.array([zlib.crc32(str(d).encode()) % buckets for d, _ in docs], pa.int32())})
    mine = by(table, "b")
    anchors = pa.concat_tables([repeats._report_anchors(spec, shards)(t) for t in mine.values()])
    repeated = pa.concat_tables([repeats._repeated_anchors(t) for t in by(anchors, "shard").values()])
    asked = by(repeated, "b")
    none = repeated.slice(0, 0)
    pieces = pa.concat_tables([repeats._send_pieces(spec, shards)(t, asked.get(b, none)) for b, t in mine.items()])
    verdicts = [repeats._judge(spec, matcher)(t) for t in by(pieces, "shard").values()]
    replies = by(pa.concat_tables([repeated, *verdicts]), "b")
    out = [repeats._remove(spec)(t, replies.get(b, none)) for b, t in mine.items()]
    return pa.concat_tables(out).to_pylist()


@pytest.mark.parametrize("block,units,hot,again", [(64, 200, 10 ** 9, 10 ** 9), (1 << 17, 1 << 18, 3, 10), (100, 500, 1, 2), (37, 10 ** 6, 2, 10 ** 9)])
def test_blocks_and_hot_anchors(monkeypatch, block, units, hot, again):
    for name, value in (("BLOCK", block), ("MATCH_UNITS", units), ("HOT_COPIES", hot), ("HOT_AGAIN", again)):
        monkeypatch.setattr(repeats, name, value)
    docs = corpus(block, 45)
    got = in_process(docs, repeats.Spec("word", 13, 5, False), automaton_matcher(13), 7, 3)
    assert sorted(((r["rest"]["doc_id"], r["n_units"], r["n_removed"], r["kept"].decode()) for r in got), key=str) == brute_words(docs, 13)
    got = in_process(docs, repeats.Spec("byte", 40, 13, True), lpf_matcher(40), 7, 3)
    assert sorted(((r["rest"]["doc_id"], r["n_units"], r["n_removed"], len(r["spans"]), r["kept"]) for r in got), key=str) == brute_bytes(docs, 40)


def test_ties_nulls_and_repeated_rows(spark):
    p = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame(rows_of([(5, p), (5, p), (None, p + " end"), (None, p), (7, p), (5, p + " more")]), SCHEMA)
    got = sorted(((r.doc_id, r.n_removed) for r in substring_dedup(df, 13).collect()), key=str)
    assert got == sorted([(5, 20), (5, 20), (None, 0), (None, 0), (7, 20), (5, 20)], key=str)
    got = suffix_dedup(df, 30).collect()
    assert sum(1 for r in got if r.n_removed == 0) == 1 and len(got) == 6


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert substring_dedup(df).collect() == [] and suffix_dedup(df).collect() == []


def test_texts_keep_the_other_columns(spark):
    df = spark.createDataFrame([(1, "ä" * 200 + "end", 5, "s"), (2, "ä" * 200, 6, None)], "doc_id int, text string, n_chars int, rest string")
    out = {r.doc_id: r for r in suffix_dedup_texts(df).collect()}
    assert set(out[1].asDict()) == {"doc_id", "text", "n_chars", "rest"}
    assert out[2].text == "" and out[2].n_chars == 0 and out[2].rest is None and out[1].rest == "s"
    assert out[1].text.endswith("end") and out[1].n_chars == len(out[1].text)


def test_automaton_matching_statistics():
    rnd = random.Random(3)
    for _ in range(50):
        refs = [[rnd.choice("abc") for _ in range(rnd.randint(1, 12))] for _ in range(3)]
        q = [rnd.choice("abcd") for _ in range(15)]
        a = SuffixAutomaton()
        for r in refs:
            a.add(r)
        known = {tuple(r[i:j]) for r in refs for i in range(len(r)) for j in range(i + 1, len(r) + 1)}
        want = [max([n for n in range(1, i + 2) if tuple(q[i + 1 - n:i + 1]) in known], default=0) for i in range(len(q))]
        assert a.matching(q) == want
