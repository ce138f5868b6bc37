"""Chat formatting by prefix-target expansion (operator 8).

A turn is written ``### role: text</turn>`` and a line end.  Inside roles and
texts the control strings (and the escape itself) are escaped by a backslash,
so a formatted conversation reads back exactly, whatever its texts say.

Every assistant turn becomes an example of its own: all turns before it as
context, and a loss mask over that reply's text alone.  A conversation is
formatted once; an example is the prefix that ends with its reply, so the
linear table ``format_conversations`` holds all examples as spans, and
``expand`` writes out their texts, one row each, with the whole conversation
after them (their total length is quadratic in the turns; that is the
method's).  Spark hands these rows on as it writes them: ``read_examples`` reads
the conversations back from them in the same task, with no shuffle between.  A
conversation is one training text and has to fit in a task's memory.

Turns are ordered by turn (null first), then role, then text; repeated rows are
turns of their own.  Null roles and texts are empty; a null conv_id is one
conversation.  Conversations without an assistant turn have no examples.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
_OPEN, _CLOSE = "### ", "</turn>"
_ESCAPE = re.compile(r"(\\|### |</turn>|:)")
_ESCAPE_TEXT = re.compile(r"(\\|### |</turn>)")
_UNESCAPE = re.compile(r"\\(\\|### |</turn>|:)")
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE_TEXT.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def write(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the span of each turn's escaped text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{_OPEN}{_ESCAPE.sub(r'\\\1', role)}: ", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, _CLOSE + "\n"]
        at = spans[-1][1] + len(_CLOSE) + 1
    return "".join(out), spans


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text; raises if it is not one."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


_FORMATTED = "conv_id bigint, formatted string, examples array<struct<example:bigint,context_end:bigint,start:bigint,end:bigint>>"
_EXAMPLES = pa.list_(pa.struct([(x, pa.int64()) for x in ("example", "context_end", "start", "end")]))
_EXPANDED = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("text", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns", pa.string()), ("loss_text", pa.string()), ("formatted_chars", pa.int64())])
_BATCH_CHARS = 4_000_000


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, examples: for each reply the end of its context and the span of its loss mask (code points)."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grouped = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batches):
        for batch in batches:
            texts, examples = [], []
            for turns in batch.column(1).to_pylist():
                text, spans = write([(t["role"], t["text"]) for t in turns])
                replies = [(a, b) for t, (a, b) in zip(turns, spans) if t["role"] == ASSISTANT]
                texts.append(text)
                head = len(_OPEN) + len(ASSISTANT) + 2
                examples.append([{"example": i, "context_end": a - head, "start": a, "end": b} for i, (a, b) in enumerate(replies)])
            yield pa.record_batch({"conv_id": batch.column(0), "formatted": pa.array(texts, pa.string()), "examples": pa.array(examples, _EXAMPLES)})
    return grouped.mapInArrow(run, _FORMATTED)


def expand(formatted: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end: one row per assistant turn (context and reply), in order.

    The whole conversation follows its examples as a row without a mask (example, loss_start, loss_end null).
    Texts are written a few at a time: an explode would hold all those of a conversation at once.
    """
    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for conv, text, examples in zip(*batch.columns):
                conv, text = conv.as_py(), text.as_py()
                for e in [*examples.as_py(), None]:
                    rows.append((conv, None, text, None, None) if e is None else
                                (conv, e["example"], text[:e["end"] + len(_CLOSE) + 1], e["start"], e["end"]))
                    size += len(rows[-1][2])
                    if size >= _BATCH_CHARS:
                        yield _batch(rows, _EXPANDED)
                        rows, size = [], 0
            if rows:
                yield _batch(rows, _EXPANDED)
    return formatted.select("conv_id", "formatted", "examples").mapInArrow(
        run, "conv_id bigint, example bigint, text string, loss_start bigint, loss_end bigint")


def prefix_examples(formatted: DataFrame) -> DataFrame:
    """conv_id, example, text (context and reply), loss_start, loss_end: one row per assistant turn."""
    return expand(formatted).where(F.col("example").isNotNull())


def read_examples(expanded: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns, loss_text, formatted_chars as ``read_back`` gives them, from the texts of ``expand``.

    Each row's text has to begin with the text of the row before it: what it adds
    is read as turns, the last of them is the reply under its mask.  Raises where
    it is not, or a row is missing, also if the rows were dealt anew since ``expand``
    wrote them.
    """
    def run(batches):
        turns, loss, before, conv = [], [], "", None
        for batch in batches:
            done = []
            for row in zip(*batch.columns):      # one text at a time
                key, example, text, start, end = (x.as_py() for x in row)
                if before and key != conv or not text.startswith(before):
                    raise ValueError(f"conversation {key}: the context of example {example} is not what comes before it")
                turns += read(text[len(before):])
                before, conv = text, key
                if example is not None:
                    loss.append(unescape(text[start:end]))
                    if example != len(loss) - 1 or turns[-1] != (ASSISTANT, loss[-1]):
                        raise ValueError(f"conversation {key}: the mask of example {example} is not over its reply")
                    continue
                if len(loss) != sum(r == ASSISTANT for r, _ in turns):
                    raise ValueError(f"conversation {key}: replies without an example")
                done.append((key, len(turns), "".join(f"{r}\n{t}\n" for r, t in turns), "".join(loss), len(text)))
                turns, loss, before = [], [], ""
            if done:
                yield _batch(done, _READ)
        if before:
            raise ValueError(f"conversation {conv} has no end")
    return expanded.select("conv_id", "example", "text", "loss_start", "loss_end").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns string, loss_text string, formatted_chars bigint")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns (role, line end, text, line end of each), loss_text, formatted_chars, from the linear table alone.

    ``loss_text`` joins what lies under the masks of the conversation's examples;
    each reply is cut from its span, no prefix is written out.
    """
    def run(batches):
        for batch in batches:
            n, turns, loss, size = [], [], [], []
            for text, examples in zip(batch.column(1), batch.column(2)):      # one conversation at a time
                text = text.as_py()
                got = read(text)
                n.append(len(got))
                turns.append("".join(f"{r}\n{t}\n" for r, t in got))
                loss.append("".join(unescape(text[e["start"]:e["end"]]) for e in examples.as_py()))
                size.append(len(text))
            yield pa.record_batch({"conv_id": batch.column(0), "n_turns": pa.array(n, pa.int64()), "turns": pa.array(turns, pa.string()),
                                   "loss_text": pa.array(loss, pa.string()), "formatted_chars": pa.array(size, pa.int64())})
    return formatted.select("conv_id", "formatted", "examples").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns string, loss_text string, formatted_chars bigint")
