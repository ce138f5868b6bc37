"""Operator 13 against whole-text encoding and plain counting."""

import hashlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest

from kalulu.llm import token_alignment as T

COLS = "doc_id bigint, text string, pair bigint, groups string"
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\nb", "a\n\nb", "a \nb", "a\n b", "a\tb \t c", "\x00\x1c \x1c x", "x▁y", "<s> </s> <0x41> <|endoftext|>",
       "it's we're 'tis I'll  'll", "¼² ½, x², 10,000.50!", "e.g. Mr. O'Neil, (yes)... no?!;:", "日本語 テキスト。 ok", "a b  c　 d", "é ́x ﬁ",
       "😀😀 👩‍👩‍👧", "x" * 300, "." * 50, " " * 40 + "z", "Zürich, straße; été: œuvre", "\r\n a\r\n", "a\u0085 b​ c", "ــ مرحبا, שלום."]


def plain(texts, folder=T.FOLDER):
    """Every text encoded whole by both libraries, links counted pair by pair."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
    byte = T._byte_level()
    found = []
    for text in texts:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        xb = [bytes(byte[c] for c in a.id_to_token(i)) if i != 50256 else b"?" for i in x]
        yb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not text or b"".join(xb) != (" " + text).encode() or b"".join(yb) != (" " + text).encode():
            x = y = xb = yb = []
        ends = lambda z: [sum(map(len, z[:i + 1])) for i in range(len(z))] if len(z) < 400 else list(accumulate(map(len, z)))
        xe, ye = ends(xb), ends(yb)
        links, groups, i, j = [], [], 0, 0
        where = {e: k for k, e in enumerate(ye)}
        for k, e in enumerate(xe):
            if e in where:
                m = where[e]
                links.append((x[k], y[m]))
                groups.append(",".join(map(str, x[i:k + 1])) + "|" + ",".join(map(str, y[j:m + 1])))
                i, j = k + 1, m + 1
        found.append((len(x), len(y), links, ";".join(groups)))
    n = Counter(p for f in found for p in f[2])
    best = {}
    for (_, b_id), c in n.items():
        best[b_id] = max(best.get(b_id, 0), c)
    return [(na, nb, len(li), len(li), sum(n[p] == best[p[1]] for p in li), sum(n[p] for p in li), g) for na, nb, li, g in found]


@pytest.mark.parametrize("shard", [T.SHARD_PAIRS, 60])
def test_against_whole_texts(spark, shard):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    texts = ODD + docs[:40 if shard > 60 else 3] + ["a\nb", "a\nb"]
    rows = [(i, t, 7, "clash") for i, t in enumerate(texts)] + [(900, None, 1, None)]
    out = T.align(spark.createDataFrame(rows, COLS), shard_pairs=shard)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    want = plain(texts)
    for i, w in enumerate(want):
        assert got[i] == w, (i, texts[i][:50])
    assert got[900] == (0, 0, 0, 0, 0, 0, "") and got[ODD.index("x▁y")][:2] == (0, 0) and got[ODD.index("")][:2] == (0, 0)
    assert sum(w[2] for w in want) > 100


def test_long_texts_bounded_caches_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(T, "SLICE_CHARS", 40)
    monkeypatch.setattr(T, "KEEP_WORDS", 3)
    monkeypatch.setattr(T, "TOGETHER", 2)
    texts = ["word, other words and more of the same " * 9, "x " * 50, "no blanks" * 30 + " ", "a  b  c " * 20, "end. "]
    rows = [(i, t, 0, "") for i, t in enumerate(texts)]
    got = {r.doc_id: r.groups for r in T.align(spark.createDataFrame(rows, COLS)).collect()}
    assert [got[i] for i in range(len(texts))] == [w[6] for w in plain(texts)]
    assert T.align(spark.createDataFrame([], COLS)).collect() == []


def test_a_stretch_that_does_not_come_back_empties_its_text(spark):
    al = T.aligner(T.FOLDER)
    found = al.encode(["a▁b", "fine", "", "x\ny"])
    assert found.n_a[0] == 0 and found.groups[0] == "" and all(found.n_a[1:]) and not (found.flat()[0] == 0).any()
    memory = T._Memory(al, *np.zeros((3, 0), np.int64))
    memory.learn(["fine", "a▁b"])
    assert memory.figures[:2, 0].tolist() == [1, 0]
    df = spark.createDataFrame([("fine one fine",)], "text string")
    assert sorted(T._by_text(df, T.FOLDER).collect()) == sorted(T.link_counts(df).collect())


def test_query_digest(spark):
    from kalulu.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    ids = sorted(docs)
    for i, w in zip(ids, plain([docs[i] for i in ids])):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == w[:6]
        assert r.groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "")
