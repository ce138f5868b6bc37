"""Operator 8: exact round trips."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kalulu.llm import chat_format as C

NASTY = st.text(alphabet=list("\\#: </turn>\nAé"), max_size=40) | st.sampled_from(
    ["\\### Assistant: </turn> ok", "### ", "</turn>", "\\", "\\\\", "x\\", "<", "###", "</turn", ""])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(NASTY, NASTY), max_size=6))
def test_round_trip(turns):
    text, spans = C.write(turns)
    assert C.read(text) == turns
    assert [C.unescape(text[a:b]) for a, b in spans] == [t for _, t in turns]


def test_examples(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", "hi"), (1, 2, "assistant", "héllo </turn>"), (1, 3, "user", None), (1, 4, "assistant", "b\\"),
            (1, 5, "user", "bye"), (2, 0, "user", "alone"), (None, 1, "assistant", "x"), (3, None, None, "t"), (3, 1, "assistant", "y"), (3, 1, "assistant", "y")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")
    out = C.format_conversations(df)
    ex = {(r.conv_id, r.example): r for r in C.prefix_examples(out).collect()}
    assert len(ex) == 5
    r = ex[1, 1]
    assert C.read(r.text) == [("system", "be"), ("user", "hi"), ("assistant", "héllo </turn>"), ("user", ""), ("assistant", "b\\")]
    assert C.unescape(r.text[r.loss_start:r.loss_end]) == "b\\"
    back = {x.conv_id: x for x in C.read_back(out).collect()}
    assert set(back) == {1, 2, 3, None}
    assert back[1].n_turns == 6 and back[1].loss_text == "héllo </turn>b\\" and back[2].loss_text == ""
    assert back[1].turns == "system\nbe\nuser\nhi\nassistant\nhéllo </turn>\nuser\n\nassistant\nb\\\nuser\nbye\n"
    assert back[3].loss_text == "yy" and back[3].turns.startswith("\nt\n")
    empty = C.format_conversations(df.where("false"))
    assert empty.collect() == [] and C.read_back(empty).collect() == []


def test_query(spark):
    from kalulu.llm.queries import op8_chat_format
    got = {r.conv_id: r for r in op8_chat_format(spark, "/root/testdata/sf0.001").collect()}
    src = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy("conv_id", "turn").collect()
    say = "\\### Assistant: </turn> ok"
    convs = {-7: [("user", say), ("assistant", say)]}
    for r in src:
        convs.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert set(got) == set(convs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (
            len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))


def test_read_back_writes_no_prefixes(spark, monkeypatch):
    monkeypatch.setattr(C, "prefix_examples", None)
    rows = [(None, i, "assistant" if i % 2 else "user", f"{i} </turn> é") for i in range(3000)]
    (r,) = C.read_back(C.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))).collect()
    assert r.n_turns == 3000 and r.loss_text == "".join(t for _, i, _, t in rows if i % 2)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("chars", [1, 4_000_000])
def test_expand_writes_every_prefix(spark, monkeypatch, chars):
    monkeypatch.setattr(C, "_BATCH_CHARS", chars)
    nasty = ["### ", "a </turn>\n", "\\", "é:\U0001f600", "", "### assistant: x</turn>\n"]
    roles = ["system", "user", "assistant", "assistant", "user", "assistant", "user"]
    convs = {c: [(roles[(i + (c or 0)) % 7], nasty[(i * 5 + (c or 0)) % 6]) for i in range(n)] for c, n in ((None, 9), (1, 7), (2, 1), (3, 6), (5, 12))}
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    out = C.expand(C.format_conversations(spark.createDataFrame(rows, SCHEMA)))
    got = {}
    for r in out.collect():
        got.setdefault(r.conv_id, []).append((r.example, r.text, r.loss_start is not None and C.unescape(r.text[r.loss_start:r.loss_end])))
    assert got == {c: [(k, C.write(turns[:i + 1])[0], turns[i][1]) for k, i in enumerate(i for i, t in enumerate(turns) if t[0] == "assistant")]
                   + [(None, C.write(turns)[0], False)] for c, turns in convs.items()}
    back = {r.conv_id: r for r in C.read_examples(out).collect()}
    assert {c: (r.n_turns, r.turns, r.loss_text, r.formatted_chars) for c, r in back.items()} == {
        c: (len(t), "".join(f"{a}\n{b}\n" for a, b in t), "".join(b for a, b in t if a == "assistant"), len(C.write(t)[0])) for c, t in convs.items()}


def test_read_examples_notices_another_context(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "b")]
    out = C.expand(C.format_conversations(spark.createDataFrame(rows, SCHEMA))).coalesce(1)
    (r,) = C.read_examples(out).collect()
    assert (r.n_turns, r.loss_text) == (4, "ab")
    second = F.col("example") == 1
    for bad in (out.withColumn("text", F.when(second, F.replace("text", F.lit("hi"), F.lit("ho"))).otherwise(F.col("text"))),
                out.withColumn("loss_end", F.when(second, F.col("loss_end") + 1).otherwise(F.col("loss_end"))),
                out.where("example = 1 or example is null"), out.where("example is not null"),
                out.where("example is null"), out.orderBy("conv_id", F.desc("example"))):
        with pytest.raises(Exception, match="conversation 1"):
            C.read_examples(bad).collect()


def test_query_reads_the_expanded_examples(spark, monkeypatch, tmp_path):
    from kalulu.llm.queries import op8_chat_format
    rows = [(c, i, "assistant" if i % 2 else "user", f"{i} </turn> é") for c in (1, None) for i in range(6)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    seen = spark.sparkContext.accumulator(0)
    written = C.expand

    def counted(formatted):
        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        out = written(formatted)
        return out.mapInArrow(run, out.schema)
    monkeypatch.setattr(C, "expand", counted)
    assert {r.conv_id: r.n_turns for r in op8_chat_format(spark, str(tmp_path)).collect()} == {1: 6, None: 6, -7: 2}
    assert seen.value == 3 + 1 + 3 + 1 + 1 + 1      # every reply and every whole conversation
    monkeypatch.setattr(C, "expand", lambda f: written(f).withColumn("text", F.replace("text", F.lit("é"), F.lit("e"))))
    plain = {r.conv_id: r.loss_sha256 for r in op8_chat_format(spark, str(tmp_path)).collect()}
    assert plain[1] == plain[None] == hashlib.sha256("".join(f"{i} </turn> e" for i in (1, 3, 5)).encode()).hexdigest()


def test_long_conversation(spark):
    rows = [(None, i, "assistant" if i % 2 else "user", f"{i} </turn> é") for i in range(3000)]
    out = C.expand(C.format_conversations(spark.createDataFrame(rows, SCHEMA)))
    assert out.count() == 1501
    (r,) = C.read_examples(out).collect()
    assert r.n_turns == 3000 and r.loss_text == "".join(t for _, i, _, t in rows if i % 2)
