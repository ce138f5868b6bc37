"""Which windows of a corpus occur earlier: content-routed exact matching.

A window is ``length`` consecutive units (bytes or words) of one document.  To
compare a corpus with itself, neither the reference nor an index of it can be
broadcast: both grow with the data.  Instead every window is routed by its own
content to the one shard that sees all its equals.

* The anchor of a window is its k-gram with the smallest hash (leftmost on
  ties).  Equal windows have equal anchors, so the anchor's hash is a routing
  key; consecutive windows that share an anchor travel together as one *piece*.
* ``anchors``: each bucket of documents reports its distinct anchor hashes, and
  each shard answers which occur more than once.  All other windows are unique
  in the corpus and go no further.
* ``pieces``: each bucket sends its distinct remaining pieces (text, place of
  the first copy); copies inside a bucket are merged before the shuffle.
* ``verdicts``: each shard finds, with the caller's matcher, the windows that
  occur earlier.  Keys only route; equality is decided on the bytes.
* The bucket turns the verdicts into removed spans.

The texts are shuffled once (all uses read the same exchange).  A shard gets at
most one row per bucket, whatever the number of copies of one passage; pieces
of an anchor with very many copies are cut by their context (`_cut`), down to
single windows keyed by their whole content, so no shard holds them all.

Order of documents: doc_id (null first), then the hash of the text; rows equal
in both are one document, each row getting its result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from kalulu.llm.common import NULL_ID, flat_bytes, is_space, parts_for, text_bytes

BUCKET_BYTES = 2 << 20      # text in one bucket of documents
SHARD_BYTES = 8 << 20       # text whose anchors meet in one shard
BLOCK = 1 << 17             # units hashed at a time
MATCH_UNITS = 1 << 18       # units given to a matcher at a time
HOT_COPIES = 50_000         # anchors with more copies are cut by context ...
CUT_WINDOWS = 16            # ... into pieces of so many windows
HOT_AGAIN = 64 * HOT_COPIES  # and beyond this into single windows

_SEED = np.random.default_rng(20_240)
_BYTE_HASH = _SEED.integers(1, 2 ** 63, 256, dtype=np.int64).astype(np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2 ** 64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base):
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)
    return run(_BASE), run(_BASE_INV)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _prefix(u: np.ndarray) -> np.ndarray:
    """Prefix sums of u[i] * base^i; see `_range_hash`."""
    out = np.zeros(len(u) + 1, np.uint64)
    up, _ = _powers(_size(len(u)))
    np.cumsum(u * up[:len(u)], out=out[1:])
    return out


def _range_hash(c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of units lo..hi, the same wherever they stand."""
    _, down = _powers(_size(len(c) - 1))
    return _mix((c[hi] - c[lo]) * down[lo])


def _size(n: int) -> int:
    return max(2 * BLOCK, 1 << int(n + 1).bit_length())


def normal_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as words with one blank after each: bytes, word starts and ends, and each text's first word."""
    n_docs = len(off) - 1
    sizes = np.diff(off)
    padded = np.full(len(data) + n_docs, 32, np.uint8)       # a blank ends each text
    keep = np.ones(len(padded), bool)
    keep[off[1:] + np.arange(n_docs)] = False
    padded[keep] = data
    space = is_space(padded)
    padded[space] = 32
    take = ~space
    take[1:] |= space[1:] & ~space[:-1]                      # one blank after each word
    ends_before = np.concatenate(([0], np.cumsum(space[1:] & ~space[:-1]) if len(space) else []))
    out = padded[take]
    blank = np.flatnonzero(out == 32)
    start = np.concatenate(([0], blank[:-1] + 1)).astype(np.int64) if len(blank) else np.zeros(0, np.int64)
    last = np.cumsum(sizes + 1) - 1                          # the blank that ends each text
    words = np.concatenate(([0], ends_before[last])).astype(np.int64) if n_docs else np.zeros(1, np.int64)
    return out, start, blank.astype(np.int64), words


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes, about a block of bytes at a time."""
    out = np.zeros(len(start), np.uint64)
    first = 0
    while first < len(start):
        stop = max(first + 1, int(np.searchsorted(end, start[first] + BLOCK, "right")))
        lo = start[first]
        c = _prefix(_BYTE_HASH[data[lo:end[stop - 1]]])
        out[first:stop] = _range_hash(c, start[first:stop] - lo, end[first:stop] - lo)
        first = stop
    return out


@dataclass(frozen=True)
class Spec:
    """What counts as a repeat."""

    unit: str            # "byte" or "word"
    length: int          # units in a window
    gram: int            # units in an anchor
    within: bool         # does an earlier start in the same document count?
    characters: bool = False    # bytes only: drop what is left of characters that were cut in part


class Bucket:
    """Documents of one bucket as units, in document order, equal rows once."""

    def __init__(self, table: pa.Table, spec: Spec):
        k = table["k"].to_numpy()
        h = table["h"].to_numpy()
        order = np.lexsort((h, k))
        k, h = k[order], h[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
        self.row_doc = np.cumsum(new) - 1          # document of each sorted row
        rest = table["rest"].combine_chunks()
        self.rest = rest.take(pa.array(order))     # the other columns of each row
        texts = table["text"].combine_chunks()
        data, off = flat_bytes(texts.take(pa.array(order[new])))
        self.k, self.h = k[new], h[new]
        if spec.unit == "byte":
            self.data, self.start, self.end = data, None, None
            self.units, self.off = _BYTE_HASH[data], off
        else:
            self._words(data, off)
        self.spec = spec
        self.doc = None

    def _words(self, data: np.ndarray, off: np.ndarray) -> None:
        self.data, self.start, self.end, self.off = normal_words(data, off)
        self.units = word_hashes(self.data, self.start, self.end)

    def text(self, lo: int, hi: int) -> tuple[int, int]:
        """Byte range of units lo..hi."""
        return (lo, hi) if self.start is None else (int(self.start[lo]), int(self.end[hi - 1]))

    def runs(self) -> dict[str, np.ndarray]:
        """Runs of windows with one anchor: first window, windows, anchor, its hash."""
        L, k, n = self.spec.length, self.spec.gram, len(self.units)
        valid = np.ones(n, bool)
        for lo, hi in zip(self.off[:-1], self.off[1:]):
            valid[max(lo, hi - L + 1):hi] = False
        got: dict[str, list] = {"first": [], "count": [], "anchor": [], "hash": []}
        mask = np.uint64((1 << 21) - 1)
        for lo in range(0, n, BLOCK):
            seg = self.units[lo:lo + BLOCK + L - 1]
            at = np.flatnonzero(valid[lo:lo + BLOCK])
            if not len(at):
                continue
            c = _prefix(seg)
            m = len(seg) - k + 1
            _, down = _powers(_size(len(seg)))
            g = _mix((c[k:] - c[:-k]) * down[:m])
            best = (g & ~mask) | np.arange(m, dtype=np.uint64)
            width, w = 1, L - k + 1
            while 2 * width <= w:
                best = np.minimum(best[:-width], best[width:])
                width *= 2
            if width < w:
                best = np.minimum(best[:len(best) - (w - width)], best[w - width:])
            pick = best[at]
            brk = np.ones(len(at), bool)
            brk[1:] = (pick[1:] != pick[:-1]) | (at[1:] != at[:-1] + 1)
            head = np.flatnonzero(brk)
            anchor = (pick[head] & mask).astype(np.int64)
            got["first"].append(at[head] + lo)
            got["count"].append(np.diff(np.append(head, len(at))))
            got["anchor"].append(anchor + lo)
            got["hash"].append(g[anchor])
        types = {"hash": np.uint64}
        return {x: np.concatenate(v) if v else np.zeros(0, types.get(x, np.int64)) for x, v in got.items()}

    def pieces(self, repeated: np.ndarray, copies: np.ndarray) -> "Pieces":
        """The pieces whose anchor is in ``repeated`` (sorted), equal ones once."""
        r = self.runs()
        if not len(repeated):
            return Pieces([], [], [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        i = np.minimum(np.searchsorted(repeated, r["hash"]), len(repeated) - 1)
        hit = repeated[i] == r["hash"]
        first, count, anchor, key = (r[x][hit] for x in ("first", "count", "anchor", "hash"))
        hot = copies[i[hit]]
        if (hot >= HOT_COPIES).any():
            first, count, key = _cut(self, first, count, anchor, key, hot)
        L = self.spec.length
        raw = self.data.tobytes()
        seen: dict[bytes, int] = {}
        bodies, keys, heads = [], [], []
        piece = np.empty(len(first), np.int64)
        lo_hi = zip(first.tolist(), (first + count + L - 1).tolist(), key.tolist())
        for j, (a, b, x) in enumerate(lo_hi):
            s, e = self.text(a, b)
            body = raw[s:e]
            p = seen.setdefault(body, len(bodies))
            if p == len(bodies):
                bodies.append(body)
                keys.append(x)
                heads.append(a)
            piece[j] = p
        return Pieces(bodies, keys, heads, first, count, piece)

    def doc_of(self, unit: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, unit, "right") - 1


@dataclass
class Pieces:
    bodies: list          # distinct texts
    keys: list            # their routing keys
    heads: list           # unit at which the first copy of each starts
    first: np.ndarray     # every copy: first window, windows, its piece
    count: np.ndarray
    piece: np.ndarray


def _cut(b: Bucket, first, count, anchor, key, hot):
    """Cut pieces of hot anchors by the place of the anchor in the window.

    Windows are classed by that place, ``g`` places a class.  All windows of a
    class hold the same stretch around the anchor; its hash is the new key.
    Equal windows have their anchor in the same place, so they meet again.
    """
    L = b.spec.length
    out = [[first[hot < HOT_COPIES]], [count[hot < HOT_COPIES]], [key[hot < HOT_COPIES]]]
    c = _prefix(b.units)
    for g, sel in ((CUT_WINDOWS, (hot >= HOT_COPIES) & (hot < HOT_AGAIN)), (1, hot >= HOT_AGAIN)):
        f, n, a = first[sel], count[sel], anchor[sel]
        if not len(f):
            continue
        run = np.repeat(np.arange(len(f)), n)
        s = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n) + f[run]
        q = (a[run] - s) // g
        new = np.ones(len(s), bool)
        new[1:] = (run[1:] != run[:-1]) | (q[1:] != q[:-1])
        head = np.flatnonzero(new)
        out[0].append(s[head])
        out[1].append(np.diff(np.append(head, len(s))))
        at, cls = a[run][head], q[head]
        lo = at - cls * g
        hi = at - np.minimum(cls * g + g - 1, L - b.spec.gram) + L     # an anchor has L - gram + 1 places
        out[2].append(_range_hash(c, lo, hi) ^ _mix(cls.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(np.concatenate(out[0]), kind="stable")
    return tuple(np.concatenate(x)[order] for x in out)


#: pieces (bytes, in document order) -> for each, the flags of its windows that occur earlier
Matcher = Callable[[list, list, list], list]


def _by_shard(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by shard; the shards that occur; where each begins."""
    shard = ((keys >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    which, at = np.unique(shard[order], return_index=True)
    return order, which, np.append(at, len(keys))


def _table(rows: list, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


_ANCHORS = pa.schema([("shard", pa.int32()), ("b", pa.int32()), ("hashes", pa.binary()), ("copies", pa.binary())])
_REPLY = pa.schema([("b", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("c", pa.binary()), ("d", pa.binary())])
_PIECES = pa.schema([("shard", pa.int32()), ("b", pa.int32())] + [(x, pa.binary()) for x in ("idx", "keys", "doc", "dh", "at", "len", "body")])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_DDL = {
    "anchors": "shard int, b int, hashes binary, copies binary",
    "reply": "b int, kind int, a binary, c binary, d binary",
    "pieces": "shard int, b int, idx binary, keys binary, doc binary, dh binary, at binary, len binary, body binary",
    "done": "n_units bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
}


def _report_anchors(spec: Spec, shards: int):
    def run(table: pa.Table) -> pa.Table:
        b = table["b"][0].as_py()
        keys, n = np.unique(Bucket(table, spec).runs()["hash"], return_counts=True)
        order, which, at = _by_shard(keys, shards)
        keys, n = keys[order], n[order].astype(np.uint32)
        rows = [{"shard": int(s), "b": b, "hashes": keys[x:y].tobytes(), "copies": n[x:y].tobytes()}
                for s, x, y in zip(which, at[:-1], at[1:])]
        return _table(rows, _ANCHORS)
    return run


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """Of each bucket's anchors, those that occur more than once in the corpus."""
    buckets = table["b"].to_pylist()
    keys = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
    copies = [np.frombuffer(x, np.uint32) for x in table["copies"].to_pylist()]
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(copies), len(every)).astype(np.int64)
    rows, at = [], 0
    for b, k in zip(buckets, keys):
        n = total[inverse[at:at + len(k)]]
        at += len(k)
        if (n > 1).any():
            rows.append({"b": b, "kind": 0, "a": k[n > 1].tobytes(), "c": np.minimum(n[n > 1], 2 ** 32 - 1).astype(np.uint32).tobytes(), "d": b""})
    return _table(rows, _REPLY)


def _asked(reply: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    rows = [r for r in reply.to_pylist() if r["kind"] == 0]
    keys = np.concatenate([np.frombuffer(r["a"], np.uint64) for r in rows] or [np.zeros(0, np.uint64)])
    copies = np.concatenate([np.frombuffer(r["c"], np.uint32) for r in rows] or [np.zeros(0, np.uint32)])
    order = np.argsort(keys)
    return keys[order], copies[order]


def _send_pieces(spec: Spec, shards: int):
    def run(docs: pa.Table, reply: pa.Table) -> pa.Table:
        if not len(docs) or not len(reply):
            return _table([], _PIECES)
        bucket = Bucket(docs, spec)
        p = bucket.pieces(*_asked(reply))
        b = docs["b"][0].as_py()
        keys, heads = np.array(p.keys, np.uint64), np.array(p.heads, np.int64)
        doc = bucket.doc_of(heads)
        order, which, at = _by_shard(keys, shards)
        rows = []
        for s, x, y in zip(which, at[:-1], at[1:]):
            o = order[x:y]
            bodies = [p.bodies[i] for i in o.tolist()]
            rows.append({
                "shard": int(s), "b": b, "idx": o.astype(np.int32).tobytes(), "keys": keys[o].tobytes(),
                "doc": bucket.k[doc[o]].tobytes(), "dh": bucket.h[doc[o]].tobytes(),
                "at": (heads[o] - bucket.off[doc[o]]).tobytes(),
                "len": np.array([len(x) for x in bodies], np.int32).tobytes(), "body": b"".join(bodies),
            })
        return _table(rows, _PIECES)
    return run


def _judge(spec: Spec, matcher: Matcher):
    """Shard: merge equal pieces, match the distinct ones, answer each bucket."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        number: dict[bytes, int] = {}
        place: list[tuple] = []           # of the first copy: doc, hash, start
        key: list[int] = []
        entries = []
        for r in rows:
            body, at = r["body"], 0
            ids = []
            where = zip(np.frombuffer(r["doc"], np.int64).tolist(), np.frombuffer(r["dh"], np.int64).tolist(), np.frombuffer(r["at"], np.int64).tolist())
            keys = np.frombuffer(r["keys"], np.uint64).tolist()
            for n, w, x in zip(np.frombuffer(r["len"], np.int32).tolist(), where, keys):
                text = body[at:at + n]
                at += n
                p = number.setdefault(text, len(place))
                if p == len(place):
                    place.append(w)
                    key.append(x)
                elif w < place[p]:
                    place[p] = w
                ids.append(p)
            entries.append(np.array(ids, np.int64))
            r["body"] = None
        texts = list(number)
        flags: dict[int, np.ndarray] = {}
        order = sorted(range(len(texts)), key=lambda i: (key[i], place[i]))
        chunk: list[int] = []
        held, at = 0, 0

        def flush():
            found = matcher([texts[i] for i in chunk], [place[i] for i in chunk], [key[i] for i in chunk])
            flags.update((i, f) for i, f in zip(chunk, found) if f is not None and f.any())

        while at < len(order):                     # pieces of one key stay together
            stop = at + 1
            while stop < len(order) and key[order[stop]] == key[order[at]]:
                stop += 1
            if stop - at > 1:                      # alone, a piece has no equal windows elsewhere
                chunk += order[at:stop]
                held += sum(len(texts[i]) for i in order[at:stop])
                if held >= MATCH_UNITS:
                    flush()
                    chunk, held = [], 0
            at = stop
        if chunk:
            flush()
        rep_doc = np.array([w[0] for w in place], np.int64)
        rep_h = np.array([w[1] for w in place], np.int64)
        rep_at = np.array([w[2] for w in place], np.int64)
        flagged = np.zeros(len(place), bool)
        flagged[list(flags)] = True
        out = []
        for r, ids in zip(rows, entries):
            doc = np.frombuffer(r["doc"], np.int64)
            if spec.within:
                same = (doc == rep_doc[ids]) & (np.frombuffer(r["dh"], np.int64) == rep_h[ids]) & (np.frombuffer(r["at"], np.int64) == rep_at[ids])
                every = ~same
            else:
                every = doc > rep_doc[ids]
            some = ~every & flagged[ids]
            if not (every.any() or some.any()):
                continue
            idx = np.frombuffer(r["idx"], np.int32)
            masks = [flags[i] for i in ids[some].tolist()]
            out.append({
                "b": r["b"], "kind": 1, "a": idx[every].tobytes(),
                "c": np.array([x for i, m in zip(idx[some].tolist(), masks) for x in (i, len(m))], np.int32).tobytes(),
                "d": np.packbits(np.concatenate(masks)).tobytes() if masks else b"",
            })
        return _table(out, _REPLY)
    return run


def _remove(spec: Spec):
    """Bucket: from the verdicts to removed spans and kept texts."""
    def run(docs: pa.Table, reply: pa.Table) -> pa.Table:
        bucket = Bucket(docs, spec)
        p = bucket.pieces(*_asked(reply))
        edge = np.zeros(len(bucket.units) + 1, np.int32)
        L = spec.length
        if len(p.first):
            every = np.zeros(len(p.bodies), bool)
            masks: dict[int, np.ndarray] = {}
            for r in reply.to_pylist():
                if r["kind"] == 1:
                    every[np.frombuffer(r["a"], np.int32)] = True
                    bits, at = np.unpackbits(np.frombuffer(r["d"], np.uint8)).astype(bool), 0
                    for i, n in np.frombuffer(r["c"], np.int32).reshape(-1, 2).tolist():
                        masks[i] = bits[at:at + n]
                        at += n
            heads = np.array(p.heads, np.int64)[p.piece]
            if spec.within:
                whole = every[p.piece] | (p.first != heads)
            else:
                whole = every[p.piece] | (bucket.k[bucket.doc_of(p.first)] > bucket.k[bucket.doc_of(heads)])
            np.add.at(edge, p.first[whole], 1)
            np.add.at(edge, p.first[whole] + p.count[whole] + L - 1, -1)
            for j in np.flatnonzero(~whole & np.isin(p.piece, np.array(list(masks), np.int64))).tolist():
                s = np.flatnonzero(masks[int(p.piece[j])]) + p.first[j]
                np.add.at(edge, s, 1)
                np.add.at(edge, s + L, -1)
        gone = np.cumsum(edge[:-1]) > 0
        return _results(bucket, gone)
    return run


def _results(bucket: Bucket, gone: np.ndarray) -> pa.Table:
    starts = gone.copy()
    starts[1:] &= ~gone[:-1]
    n_docs = len(bucket.k)
    off = bucket.off
    starts[off[:-1][off[:-1] < len(gone)]] = gone[off[:-1][off[:-1] < len(gone)]]
    stops = gone.copy()
    stops[:-1] &= ~gone[1:]
    last = off[1:][np.diff(off) > 0] - 1
    stops[last] = gone[last]
    s, e = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    doc = bucket.doc_of(s)
    cut = np.searchsorted(doc, np.arange(n_docs + 1))
    total = np.concatenate(([0], np.cumsum(gone)))
    raw = bucket.data.tobytes()
    kept, spans = [], []
    for d in range(n_docs):
        lo, hi = int(off[d]), int(off[d + 1])
        a, z = s[cut[d]:cut[d + 1]].tolist(), e[cut[d]:cut[d + 1]].tolist()
        spans.append([{"start": x - lo, "end": y - lo} for x, y in zip(a, z)])
        holes = [lo, *(v for xy in zip(a, z) for v in xy), hi]
        ranges = [bucket.text(x, y) for x, y in zip(holes[::2], holes[1::2]) if y > x]
        left = (b"" if bucket.start is None else b" ").join(raw[x:y] for x, y in ranges)
        kept.append(left.decode("utf-8", "ignore").encode() if bucket.spec.characters and len(ranges) + bool(a) > 1 else left)
    r = bucket.row_doc
    return pa.table({
        "rest": bucket.rest, "n_units": np.diff(off)[r], "n_removed": (total[off[1:]] - total[off[:-1]])[r],
        "spans": pa.array(spans, _SPANS).take(pa.array(r)),
        "kept": pa.array(kept, pa.binary()).take(pa.array(r)),
    })


def remove_repeats(docs: DataFrame, spec: Spec, matcher: Matcher) -> DataFrame:
    """For each row of ``docs``: rest (a struct of its columns but ``text``),
    n_units, n_removed, spans (in units), kept (bytes).

    Matching reads ``doc_id`` and ``text`` only.  A null text is empty; a null
    doc_id comes before all others; rows with one doc_id and one text are one
    document; an empty table gives an empty result.
    """
    text, doc_id = F.coalesce(F.col("text"), F.lit("")), F.col("doc_id").cast("long")
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    base = docs.select(
        rest.alias("rest"), text.alias("text"), F.coalesce(doc_id, F.lit(NULL_ID)).alias("k"), F.xxhash64(text).alias("h"))
    total = text_bytes(docs)
    buckets, shards = parts_for(total, BUCKET_BYTES), parts_for(total, SHARD_BYTES)
    base = base.withColumn("b", F.pmod(F.xxhash64("k", "h"), F.lit(buckets)).cast("int"))
    done = StructType([StructField("rest", base.schema["rest"].dataType), *StructType.fromDDL(_DDL["done"])])
    anchors = base.groupBy("b").applyInArrow(_report_anchors(spec, shards), _DDL["anchors"])
    repeated = anchors.groupBy("shard").applyInArrow(_repeated_anchors, _DDL["reply"])
    pieces = base.groupBy("b").cogroup(repeated.groupBy("b")).applyInArrow(_send_pieces(spec, shards), _DDL["pieces"])
    verdicts = pieces.groupBy("shard").applyInArrow(_judge(spec, matcher), _DDL["reply"])
    replies = repeated.unionByName(verdicts)
    return base.groupBy("b").cogroup(replies.groupBy("b")).applyInArrow(_remove(spec), done)
