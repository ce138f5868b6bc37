"""Personal data by bootstrapped contextual extraction (operator 11).

Seeds are the entities that strict patterns find (``base_spans``: email, ip,
card, phone).  Looser forms (``loose_spans``: obfuscated addresses, numbers of
7 to 19 digits, address groups) are candidates of a kind, nothing more.  The words
around seeds and candidates are lexical patterns: up to three tokens before, up
to two after (case and digits folded).  Patterns and instances form a graph, scored in
``ROUNDS`` rounds of joins:

* confidence of a pattern for a kind: known / (known + contrary + unknown / 4),
  times the share of the pattern's occurrences in the whole corpus that stand
  next to something of the kind's form; at least ``MIN_SEEDS`` distinct known
  instances.  So "the" is no pattern however many seeds follow it.
* confidence of an instance: 1 - (1 - best pattern before)(1 - best after).
  Instances at ``ACCEPT`` or more are known in the next round, by that weight.

After the last round every occurrence of an accepted instance is a new span.

The corpus is read twice: for spans and their contexts, and to count how often
the eligible patterns' words occur.  That scan tests tokens against a bitmap of
fixed size (``BITMAP_BITS``); what it lets through by chance drops out of the
join that follows.  All other steps are joins and sums of pattern counts.

Offsets are code points, ends exclusive.  Nulls: a null text is empty; a null doc_id
is kept.  Repeated rows give a row each; equal instances count once as
distinct.  A text without entities has empty lists; without seeds nothing is added; an
empty table gives no rows.  Other columns are not read.  Contexts are read from
``WINDOW`` characters around a span, all else from whole texts; texts are counted ``PIECE``
bytes at a time.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalulu.llm.common import checkpoint, flat_bytes

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
ROUNDS = 3
MIN_SEEDS = 3
ACCEPT = 0.5
FLOOR = 0.1               # a pattern below it does not speak for an instance
BITMAP_BITS = 23
WINDOW = 240
PIECE = 1 << 22

# fixed values: the strict patterns of the contract
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")       # a run of digits alone is taken too, so that it is read once
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# loose forms
_AT = re.compile(r"\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s|@", re.I)
_DOT = r"(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?|\sdot\s)"
_LOOSE_DOMAIN = re.compile(rf"[\w-]+(?:{_DOT}[\w-]+)*", re.I)
_LOOSE_LOCAL = re.compile(r"[\w.%+-]+\Z")
_NUMBER = re.compile(r"(?<![\w@.#])[+(]?[0-9](?:[\x20()./·:-]{0,2}[0-9])+(?![\w@])")
_HEX = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}:?[0-9A-Fa-f]{1,4}(?![\w:])")
_DOT_WORD = re.compile(r"(?i:[\s\[({<]dot[\s\])}>])")
_ANY = re.compile(r"[0-9@]|(?i:dot)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strict patterns, leftmost and apart within a kind; sorted."""
    out = []
    after, at = 0, text.find("@")
    while at >= 0:                                      # the run before an @ is the only place a match can start
        lo = at
        while lo > after and text[lo - 1] in _LOCAL:
            lo -= 1
        domain = _DOMAIN.match(text, at + 1) if lo < at else None
        if domain:
            out.append((lo, EMAIL, domain.end()))
        after = domain.end() if domain else at + 1
        at = text.find("@", after)
    for run in _DOTTED.finditer(text):                  # of a run of dotted numbers every four parts are a match
        start, parts = run.start(), run.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                out.append((start, IP, end))
            start = end + 1
    for m in _DIGITS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((m.start(), PHONE, m.end()))
    return sorted(out)


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, list[int]]]:
    """(start, end, kinds it may be) of the looser forms that touch no strict span, apart from each other."""
    held = sorted((s, e) for s, _, e in taken)
    found: list[tuple[int, int, list[int]]] = []
    if "@" in text or _DOT_WORD.search(text):
        for m in _AT.finditer(text):
            domain = _LOOSE_DOMAIN.match(text, m.end())
            local = _LOOSE_LOCAL.search(text, max(0, m.start() - 64), m.start())
            if domain and local:
                if m.group().strip().lower() == "at" and not re.search(rf"{_DOT}", domain.group(), re.I):
                    continue
                found.append((local.start(), domain.end(), [EMAIL]))
    for m in _HEX.finditer(text):
        found.append((m.start(), m.end(), [IP]))
    for m in _NUMBER.finditer(text):
        n = sum("0" <= c <= "9" for c in m.group())
        dots = m.group().count(".")
        kinds = [IP] * (dots == 3 and n <= 12 and m.group().replace(".", "").isdigit()) + [CARD] * (12 <= n <= 19) + [PHONE] * (7 <= n <= 15)
        if kinds:
            found.append((m.start(), m.end(), kinds))
    out, end, i = [], 0, 0
    for s, e, kinds in sorted(found, key=lambda x: (x[0], -x[1])):
        while i < len(held) and held[i][1] <= s:
            i += 1
        if s >= end and not (i < len(held) and held[i][0] < e):
            out.append((s, e, kinds))
            end = e
    return out


def instance_text(kind: int, surface: str) -> str:
    """What makes two spans one instance: an address without case and disguise, a number's digits."""
    if kind == EMAIL:
        x = re.sub(r"\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s", "@", surface.lower())
        return re.sub(_DOT, ".", x)
    return surface.lower() if ":" in surface or kind == IP else "".join(c for c in surface if "0" <= c <= "9")


# tokens of a context: runs of letters, digits and non-ASCII bytes; every other byte but blanks by itself
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_FOLDED = np.arange(256, dtype=np.uint64) + np.uint64(1)
_FOLDED[65:91] += np.uint64(32)
_FOLDED[48:58] = np.uint64(49)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Start, end and hash of the tokens of texts laid back to back; none spans two texts."""
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    kind = _CLASS[data]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    first[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], n)
    word = kind[starts] != 0
    starts, ends = starts[word], ends[word]
    # a token's hash: its bytes as digits of a number, modulo 2^64, from sums of eight bytes' place values
    size = ends - starts
    value = np.zeros(len(starts), np.uint64)
    left = np.arange(len(starts))
    step = 0
    while len(left):                                    # as many rounds as the longest token has bytes, each over fewer tokens
        value[left] = value[left] * _BASE + _FOLDED[data[starts[left] + step]]
        step += 1
        left = left[size[left] > step]
        if step == 64:                                  # long tokens one by one
            for t in left.tolist():
                v = int(value[t])
                for b in _FOLDED[data[starts[t] + 64:ends[t]]].tolist():
                    v = (v * int(_BASE) + b) & 0xFFFFFFFFFFFFFFFF
                value[t] = v
            break
    return starts, ends, value


def ngrams(value: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` tokens in a row; entry i begins at token i."""
    out = value[:len(value) - n + 1].copy() if len(value) >= n else value[:0]
    for k in range(1, n):
        out = out * _STEP + value[k:len(value) - n + 1 + k]
    out = (out ^ (out >> np.uint64(29))) * _BASE + np.uint64(n)
    return out ^ (out >> np.uint64(32))


def context(text: str, start: int, end: int) -> tuple[list[int], list[int]]:
    """Hashes of the one to three tokens before a span, and of the one or two after it."""
    before, after = [], []
    lo = max(0, start - WINDOW)
    raw = np.frombuffer(text[lo:start].encode(), np.uint8)
    value = tokens(raw, np.array([0, len(raw)]))[2][1 if lo else 0:]      # the first of a cut window may be part of a token
    for n in (1, 2, 3):
        if len(value) >= n:
            before.append(int(ngrams(value[-n:], n)[0].astype(np.int64)))
    hi = min(len(text), end + WINDOW)
    raw = np.frombuffer(text[end:hi].encode(), np.uint8)
    value = tokens(raw, np.array([0, len(raw)]))[2]
    value = value[:-1] if hi < len(text) else value
    for n in (1, 2):
        if len(value) >= n:
            after.append(int(ngrams(value[:n], n)[0].astype(np.int64)))
    return before, after


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_SEEN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("seed", pa.bool_()),
                   ("before", pa.list_(pa.int64())), ("after", pa.list_(pa.int64()))])
_ROWS = ("doc_id bigint, base array<struct<start:int,kind:int,end:int>>, "
         "seen array<struct<start:int,kind:int,end:int,instance:string,seed:boolean,before:array<bigint>,after:array<bigint>>>")


def _look(text: str) -> tuple[list, list]:
    if not _ANY.search(text):
        return [], []
    base = base_spans(text)
    seen = []
    for s, k, e in base:
        before, after = context(text, s, e)
        seen.append((s, k, e, instance_text(k, text[s:e]), True, before, after))
    for s, e, kinds in loose_spans(text, base):
        before, after = context(text, s, e)
        for k in kinds:
            seen.append((s, k, e, instance_text(k, text[s:e]), False, before, after))
    return base, seen


def _read(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            base, seen = [], []
            for text in part.column(1):
                b, s = _look(text.as_py() or "")
                base.append([dict(zip(("start", "kind", "end"), x)) for x in b])
                seen.append([dict(zip(("start", "kind", "end", "instance", "seed", "before", "after"), x)) for x in s])
            yield pa.record_batch({"doc_id": part.column(0), "base": pa.array(base, pa.list_(_SPAN)), "seen": pa.array(seen, pa.list_(_SEEN))})


def _text_pieces(data: np.ndarray, offsets: np.ndarray):
    """The bytes of the texts, at most about ``PIECE`` at a time; a long text is cut at blanks, its last tokens carried on."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, "right")) - 1)
        piece, off = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        at = 0
        while len(piece) - at > 2 * PIECE:                          # then it is one text
            blanks = np.flatnonzero(_CLASS[piece[at + PIECE:at + 2 * PIECE]] == 0)
            stop = at + PIECE + int(blanks[0]) if len(blanks) else len(piece)
            yield piece[at:stop], np.array([0, stop - at]), at > 0
            at = stop
        yield piece[at:], (off if at == 0 else np.array([0, len(piece) - at])), at > 0
        lo = hi


def context_totals(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """words, total: how often the words of the patterns (column ``words``) occur in the corpus."""
    slots = F.shiftright(F.col("words"), 64 - BITMAP_BITS).bitwiseAND((1 << BITMAP_BITS) - 1)
    marks = patterns.select(slots.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()      # at most 2^17 rows
    bits = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    bits[marks.column("at").to_numpy()] = marks.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        mask = shared.value.view(np.uint64)
        for batch in batches:
            carry = np.zeros(0, np.uint64)
            for data, off, goes_on in _text_pieces(*flat_bytes(batch.column(0))):
                starts, _, value = tokens(data, off)
                if goes_on:
                    value = np.concatenate([carry, value])
                owner = np.searchsorted(off, starts, "right")
                owner = np.concatenate([np.full(len(value) - len(owner), 1), owner])
                kept = []
                for n in (1, 2, 3):
                    key = ngrams(value, n)
                    key = key[owner[:len(key)] == owner[n - 1:]]
                    if goes_on and n <= len(carry) + 1:             # those that end in the part before were counted there
                        key = key[max(0, len(carry) - n + 1):]
                    slot = key >> np.uint64(64 - BITMAP_BITS)
                    kept.append(key[(mask[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1])
                carry = value[-2:]
                words, total = np.unique(np.concatenate(kept), return_counts=True)
                yield pa.record_batch({"words": pa.array(words.view(np.int64)), "total": pa.array(total.astype(np.int64))})
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "words bigint, total bigint")
    return counts.groupBy("words").agg(F.sum("total").alias("total")).join(patterns.select("words").distinct(), "words", "left_semi")


def score_graph(edges: DataFrame, totals: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """kind, instance, score of the candidates accepted in the last round.

    ``edges``: words, side, kind, instance, seed, n (occurrences of the instance there).
    """
    known = edges.where("seed").select("kind", "instance").distinct().withColumn("weight", F.lit(1.0))
    accepted = None
    for _ in range(rounds):
        e = edges.join(known, ["kind", "instance"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
        sums = [F.sum(F.when(F.col("kind") == k, x).otherwise(0.0)).alias(f"{name}{k}") for k in range(len(KINDS)) for name, x in (
            ("known", F.col("n") * F.col("weight")), ("unknown", F.col("n") * (1 - F.col("weight"))), ("distinct", (F.col("weight") > 0).cast("int")))]
        p = e.groupBy("words", "side").agg(*sums).join(totals, "words")
        spoken = [F.col(f"known{k}") for k in range(len(KINDS))]
        rows = F.explode(F.array(*[F.struct(
            F.lit(k).alias("kind"), F.col(f"distinct{k}").alias("distinct"),
            (F.col(f"known{k}") / (sum(spoken[1:], spoken[0]) + F.col(f"unknown{k}") / 4)
             * F.least(F.lit(1.0), (F.col(f"known{k}") + F.col(f"unknown{k}")) / F.col("total"))).alias("confidence"))
            for k in range(len(KINDS))]))
        p = p.select("words", "side", rows.alias("r")).select("words", "side", "r.*").where(
            (F.col("distinct") >= MIN_SEEDS) & (F.col("confidence") >= FLOOR)).drop("distinct")
        best = [F.coalesce(F.max(F.when(F.col("side") == s, F.col("confidence"))), F.lit(0.0)) for s in (0, 1)]
        scores = edges.where("not seed").join(p, ["words", "side", "kind"]).groupBy("kind", "instance").agg(
            (1 - (1 - best[0]) * (1 - best[1])).alias("score")).where(F.col("score") >= ACCEPT)
        seeds = edges.where("seed").select("kind", "instance").distinct()
        accepted = checkpoint(scores.join(seeds, ["kind", "instance"], "left_anti"))
        known = seeds.withColumn("weight", F.lit(1.0)).unionByName(accepted.withColumnRenamed("score", "weight"))
    return accepted


def find_pii(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base, added (arrays of start, kind, end; added ones with their score): a row for each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = checkpoint(rows.mapInArrow(_read, _ROWS).withColumn("row", F.monotonically_increasing_id()))
    seen = read.where(F.size("seen") > 0).select("row", F.explode("seen").alias("s")).select("row", "s.*")
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("before").alias("all")), F.struct(F.lit(1).alias("side"), F.col("after").alias("all")))
    at = seen.select("kind", "instance", "seed", F.explode(sides).alias("x")).select("kind", "instance", "seed", "x.side", F.explode("x.all").alias("words"))
    edges = at.groupBy("words", "side", "kind", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("n"))
    eligible = edges.where("seed").groupBy("words", "side").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= MIN_SEEDS)
    edges = checkpoint(edges.join(eligible.drop("seeds"), ["words", "side"], "left_semi"))
    totals = checkpoint(context_totals(docs, edges.select("words").distinct()))
    accepted = score_graph(edges, totals, rounds)
    new = seen.where("not seed").join(accepted, ["kind", "instance"])
    new = new.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"), F.max("score").alias("score"))
    new = new.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "score"))).alias("added"))     # of one text
    none = F.array().cast("array<struct<start:int,kind:int,end:int,score:double>>")
    return read.join(new, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def span_text(spans: Column) -> Column:
    """"kind:start:end,..." of sorted spans."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")
