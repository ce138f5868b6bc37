"""Operator 11: strict patterns against plain regular expressions, counts against plain Python, planted contexts."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kalulu.llm import pii as P

COLS = "doc_id bigint, text string, base string, row bigint, words string"


def plain_base(text):
    """The contract's patterns, run as they are written."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    texts = ["a@b.c", "é.55@mail7.example.com geiever", "a@b@c.d", "a@@b.c", "@b.c", "x@y.", "x@y..z", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.1", "00000255.1.1.1",
             "4111 1111 1111 1111", "4111-1111-1111-1111 2", "+1 (017) 555-7713", "+1+2 333 444 555 666", "+1 ((((((", "+49 30 1234567890123", "a+1 555 555 5555@x.yz", "4111111111111111 4111111111111111", "1.2.3.4@5.6"]
    texts += ["".join(rng.choice("ab@.+-0123456789 ()é%_" if i % 2 else "12345.. @+a-") for _ in range(rng.randint(0, 60))) for i in range(6000)]
    for t in texts:
        assert P.base_spans(t) == plain_base(t), t
    assert P.base_spans("a" * 300_000 + " " + "1" * 300_000 + "." + "(" * 300_000) == []


def planted(n_seed=12, n_new=6):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    filler = lambda k: " ".join(word() for _ in range(k))
    rows, want = [], {}
    for i in range(n_seed):
        rows.append(f"{filler(8)} call me at +1 (555) 555-{1000 + i * 7} {filler(5)}")
        rows.append(f"{filler(4)} my e-mail: {word()}.{i}@mail.example.com, {filler(5)}")
        rows.append(f"{filler(6)} the {i}x{word()} of {word()}{i}@the.example.org {filler(3)}")
    for i in range(n_new):
        for a, form in ((f"{filler(7)} call me at ", f"555-201-{3000 + i}"), (f"{filler(3)} my e-mail: ", f"{word()} (at) example (dot) com")):
            want[len(rows)] = (len(a), len(a) + len(form))
            rows.append(a + form + f" {filler(4)}")
    for i in range(40):
        rows.append(f"{filler(5)} the order number is 20{i:02d}-555-{3000 + i * 11} of {filler(4)} look at the {filler(1)}")
    return rows, want


def test_patterns_find_unseen_identifiers_and_leave_others(spark):
    rows, want = planted()
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(rows)], COLS)
    out = P.find_pii(df)
    assert out.columns == ["doc_id", "base", "added"]
    got = {r.doc_id: r for r in out.collect()}
    assert {i: [(x.start, x.end) for x in r.added] for i, r in got.items() if r.added} == {i: [s] for i, s in want.items()}
    for i, t in enumerate(rows):
        assert [tuple(x) for x in got[i].base] == plain_base(t)
    kinds = {P.KINDS[x.kind] for r in got.values() for x in r.added}
    assert kinds == {"phone", "email"} and all(x.score >= P.ACCEPT for r in got.values() for x in r.added)


def test_query_columns(spark, tmp_path):
    from kalulu.llm.queries import QUERIES
    rows, want = planted()
    spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    for r in QUERIES["op11_pii"](spark, str(tmp_path)).collect():
        base = plain_base(rows[r.doc_id])
        text = lambda spans: ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(text(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        new = [(want[r.doc_id][0], 3 if "call me" in rows[r.doc_id] else 0, want[r.doc_id][1])] if r.doc_id in want else []
        assert r.spans == text(sorted(base + new)) and r.n_added == len(new)


def plain_tokens(text):
    raw = text.encode()
    out = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^\x20\x09\x0b-\x0d0-9A-Za-z\x80-\xff]", raw)
    return [re.sub(rb"[0-9]", b"0", x.lower()) for x in out]


@pytest.mark.parametrize("piece", [1 << 22, 40])
def test_context_totals_against_plain_counts(spark, monkeypatch, piece):
    monkeypatch.setattr(P, "PIECE", piece)
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["a", "bé", "C-3", "\n", "dd", "e"]) for _ in range(rng.randint(0, 120))) for _ in range(50)] + [None, "", "y" * 90 + " a bé"]
    counts = {}
    for t in texts:
        tok = plain_tokens(t or "")
        for n in (1, 2, 3):
            for i in range(len(tok) - n + 1):
                key = tuple(tok[i:i + n])
                counts[key] = counts.get(key, 0) + 1

    def key_hash(key):
        values = []
        for x in key:
            raw = np.frombuffer(x, np.uint8)
            values.append(P.tokens(raw, np.array([0, len(raw)]))[2][0])
        return int(P.ngrams(np.array(values, np.uint64), len(key))[0].astype(np.int64))
    keys = {key_hash(k): n for k, n in counts.items()}
    assert len(keys) == len(counts)
    some = sorted(keys)[::2] + [12345]
    patterns = spark.createDataFrame([(k,) for k in some], "words bigint")
    df = spark.createDataFrame([(i, t, "", 0, "z") for i, t in enumerate(texts)], COLS).coalesce(1)
    got = {r.words: r.total for r in P.context_totals(df, patterns).collect()}
    assert got == {k: keys[k] for k in some if k in keys}


def test_contexts_are_the_tokens_around(spark):
    text = "x " * 200 + "mail to: me@b.example.com; thanks 4711 " + "y " * 200
    (s, _, e), = P.base_spans(text)
    before, after = P.context(text, s, e)
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, value = P.tokens(raw, np.array([0, len(raw)]))
    i, j = int(np.searchsorted(ends, s, "right")), int(np.searchsorted(starts, e))
    assert before == [int(P.ngrams(value[i - n:i], n)[0].astype(np.int64)) for n in (1, 2, 3)]
    assert after == [int(P.ngrams(value[j:j + n], n)[0].astype(np.int64)) for n in (1, 2)]
    long = np.frombuffer(b"q" * 100 + b" " + b"q" * 100 + b" " + b"q" * 99, np.uint8)
    v = P.tokens(long, np.array([0, len(long)]))[2]
    assert v[0] == v[1] != v[2]


def test_odd_rows(spark):
    long = "word " * 200_000 + "call +1 (555) 555-1234"
    rows = [(1, None, "", 0, ""), (2, "", "", 0, ""), (None, "a.b@c.example.com", "", 0, ""), (3, "9.9.9.9", None, None, None), (3, "9.9.9.9", None, None, None), (4, long, "", 0, "")]
    got = sorted(((r.doc_id or 0, [tuple(x) for x in r.base], r.added) for r in P.find_pii(spark.createDataFrame(rows, COLS)).collect()), key=str)
    assert got == sorted(((i or 0, plain_base(t or ""), []) for i, t, *_ in rows), key=str)
    assert P.find_pii(spark.createDataFrame([], COLS)).collect() == []
    assert pa.types.is_int32(P._SPAN.field("start").type)
