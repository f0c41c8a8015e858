"""Suffix-array dedup by a common-prefix-aware distributed merge sort.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document with a smaller id.

The array is sparse. Every string of 50 bytes is represented by its anchor: the leftmost place, of its
first 27, whose 24 bytes have the smallest hash. Equal strings have their anchor at the same place, so sorting
the suffixes at anchors, each with the bytes before it, finds every repeat with a fourteenth of the suffixes.

1. Anchors whose 24 bytes occur once in the corpus drop out (a chunk sends sorted 32-bit marks to buckets, as
   compressed differences, and gets a bit back for each; through relays where there are many buckets, as in ``substring_dedup``): most suffixes end here.
2. A chunk sorts the others: suffix (50 bytes), then the bytes before it (26, nearest first), and sends
   distinct ones only, with their smallest doc_id, as front-coded runs (common prefix length, rest).
3. A bucket merges its runs in a loser tree that keeps, for every head, its common prefix with the last output,
   and compares from there on; characters known to be equal are never compared again. From the merged
   sequence and its common prefix lengths follow, for each of the 27 strings of an entry, the
   smallest doc_id that has it.
4. The chunk marks its strings whose smallest doc_id is under its own and cuts the bytes they cover.

Runs are dealt to buckets by the hash of a suffix's first 24 bytes: neighbours that matter stay together, and
a frequent prefix does not make a hot range. A string costs a bucket one entry a chunk, however often it repeats.

The second exchange carries only suffixes whose 24 bytes repeat. Where it has over ``top`` merging buckets, relays stand between here too: a relay merges
the runs of as many chunks as make a bucket's entries together, for one of ``top`` parts, sends runs on to the buckets of that part, and takes
their answers apart again. So its rows, and the entries they hold, are in proportion to the input.

Cases: null text is empty; ties (equal strings) go to the smallest doc_id, so its copy stays; very long texts are one row of a chunk; empty and short texts lose nothing; a null doc_id counts as larger than all; rows
with the same doc_id never cut one another; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunked, mix, pack, text_bytes, unpack, utf8
from .substring_dedup import EXCHANGE, REPLY, TOP, _by_step, _received, _send, answers, bucket_count, groups

LENGTH, GRAM, CHUNK_BYTES, BUCKET_ANCHORS = 50, 24, 6 << 20, 1_000_000
SPAN = LENGTH - GRAM + 1  # places an anchor can have in a string
LEFT = SPAN - 1
WIDTH = LENGTH + LEFT
RUN = "chunk int, bucket int, prefix binary, rest binary, docs binary"
_U = np.uint64
_NONE = np.iinfo(np.int64).max


def gram_hash(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Of 24 bytes, as three numbers."""
    h = mix(a ^ _U(0x9E3779B97F4A7C15)) + b
    return mix(mix(h) + c)


class _Chunk:
    """The anchors of a chunk's documents, in the order of their ids and texts."""

    def __init__(self, docs: pa.Table):
        ids, texts = docs.column("doc_id").to_pylist(), utf8(docs.column("text"))
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids, self.texts = [ids[i] for i in order], [texts[i] for i in order]
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        n = int(sizes.sum())
        self.n = n
        self.raw = b"\xff" * LEFT + b"".join(self.texts) + b"\xff" * 128
        self.arr = np.frombuffer(self.raw, np.uint8)[LEFT : LEFT + n + 64]
        words = np.ndarray((n + 64,), "<u8", self.raw, LEFT, (1,))
        at = np.zeros(n, np.int32)
        step, low = 1 << 17, _U((1 << 18) - 1)
        for s in range(0, n, step):
            e = min(s + step, n)
            v = words[s : e + LEFT + 16]
            k = v[:-16] * _U(0x9E3779B97F4A7C15) + (v[8:-8] ^ _U(0x5851F42D4C957F2D)) * _U(0xC2B2AE3D27D4EB4F) + v[16:] * _U(0x165667B19E3779F9)
            k ^= k >> _U(32)
            k *= _U(0xD6E8FEB86659FD93)
            k ^= k >> _U(29)
            k = (k & ~low) | np.arange(len(k), dtype=_U)
            for w in (1, 2, 4, 8):
                k = np.minimum(k[:-w], k[w:])
            k = np.minimum(k[: e - s], k[SPAN - 16 : SPAN - 16 + e - s])
            at[s:e] = (k & low).astype(np.int32) + s
        whole = np.ones(n + 1, bool)
        near = (self.end[:, None] - np.arange(1, LENGTH)[None, :])
        near = np.where(near >= self.start[:, None], near, n)
        whole[near.ravel()] = False
        self.places = np.flatnonzero(whole[:n])  # where a string of LENGTH bytes of one document starts
        of = at[self.places]
        new = np.ones(len(of), bool)
        new[1:] = of[1:] != of[:-1]
        self.anchors = of[new].astype(np.int64)
        self.which = np.cumsum(new) - 1  # of a place: the number of its anchor
        a = self.anchors
        self.h = gram_hash(words[a], words[a + 8], words[a + 16])
        self.doc = np.searchsorted(self.end, a, "right")
        doc_ids = np.array([_NONE if i is None else i for i in self.ids], np.int64)
        self.doc_ids = doc_ids

    def entries(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of the anchors in use, sorted; their hashes, smallest ids, and each anchor's key number."""
        a = self.anchors[use]
        doc = self.doc[use]
        window = np.lib.stride_tricks.sliding_window_view(np.frombuffer(self.raw, np.uint8), WIDTH)
        rows = window[a]  # LEFT bytes before the anchor, then LENGTH from it on
        key = np.empty((len(a), WIDTH), np.uint8)
        key[:, :LENGTH] = rows[:, LEFT:]
        key[:, LENGTH:] = rows[:, :LEFT][:, ::-1]
        right, left = self.end[doc] - a, a - self.start[doc]
        for i in np.flatnonzero(right < LENGTH):
            key[i, right[i] : LENGTH] = 255
        for i in np.flatnonzero(left < LEFT):
            key[i, LENGTH + left[i] :] = 255
        order = np.argsort(key.view(f"S{WIDTH}").ravel(), kind="stable")
        s = key[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]).any(1)
        first = np.flatnonzero(new)
        rank = np.empty(len(a), np.int64)
        rank[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(self.doc_ids[doc][order], first) if len(first) else np.zeros(0, np.int64)
        return s[first], self.h[use][order][first], least, rank


def prefixes(keys: np.ndarray) -> np.ndarray:
    """Of sorted rows: the common prefix length with the row before."""
    out = np.zeros(len(keys), np.uint8)
    if len(keys) > 1:
        differ = keys[1:] != keys[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), keys.shape[1])
    return out


def encode_run(keys: np.ndarray) -> tuple[bytes, bytes]:
    lcp = prefixes(keys)
    return pack(lcp.tobytes()), pack(keys[np.arange(keys.shape[1])[None, :] >= lcp[:, None]].tobytes())


def decode_run(prefix: bytes, rest: bytes, width: int = WIDTH) -> tuple[list[bytes], list[int]]:
    lcp, data = list(unpack(prefix)), unpack(rest)
    keys, last, at = [], b"", 0
    for n in lcp:
        last = last[:n] + data[at : at + width - n]
        at += width - n
        keys.append(last)
    return keys, lcp


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """The run of each output in order, and its common prefix length with the output before.

    A loser tree. Each head carries its common prefix length with the last output: the longer one is the
    smaller head; only heads with equal lengths are compared, from that length on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (size - len(runs))
    known = [0 if h is not None else -1 for h in heads]
    place = [0] * len(runs)
    tree = [0] * size

    def play(x: int, y: int) -> tuple[int, int]:
        a, b = known[x], known[y]
        if a != b:
            return (x, y) if a > b else (y, x)
        if a < 0:
            return x, y
        s, t = heads[x][a:], heads[y][a:]
        if s == t:
            known[max(x, y)] = a + len(s)
            return (x, y) if x < y else (y, x)
        n = len(s)
        same = n - ((int.from_bytes(s) ^ int.from_bytes(t)).bit_length() + 7) // 8
        if s < t:
            known[y] = a + same
            return x, y
        known[x] = a + same
        return y, x

    def build(node: int) -> int:
        if node >= size:
            return node - size
        win, lose = play(build(2 * node), build(2 * node + 1))
        tree[node] = lose
        return win

    win = build(1)
    out, lcps = [], []
    while heads[win] is not None:
        out.append(win)
        lcps.append(known[win])
        place[win] += 1
        keys, lcp = runs[win]
        if place[win] < len(keys):
            heads[win], known[win] = keys[place[win]], lcp[place[win]]
        else:
            heads[win], known[win] = None, -1
        node = (win + size) // 2
        while node:
            other = tree[node]
            a, b = known[win], known[other]
            if a > b:
                pass
            elif b > a:
                tree[node], win = win, other
            else:
                win, tree[node] = play(win, other)
            node //= 2
    return out, lcps


def smallest(keys: np.ndarray, lcp: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For sorted distinct keys: the smallest doc_id that has each of an entry's SPAN strings."""
    n = len(keys)
    out = np.repeat(docs[:, None], SPAN, 1)
    gram = np.cumsum(lcp < GRAM) - 1
    shared = np.bincount(gram)[gram] > 1 if n else np.zeros(0, bool)
    at = np.flatnonzero(shared)
    if not len(at):
        return out
    # Between members of one group no key outside it stands, so their prefix lengths hold.
    left = np.zeros(len(at), np.int64)
    for o in range(SPAN):
        if o:
            left = np.unique(left * 257 + keys[at, LENGTH + o - 1], return_inverse=True)[1]
        right = np.cumsum(lcp < LENGTH - o)[at]
        _, group = np.unique(right * (int(left.max()) + 1) + left, return_inverse=True)
        least = np.full(int(group.max()) + 1, _NONE)
        np.minimum.at(least, group, docs[at])
        out[at, o] = least[group]
    return out


def _merged(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of several runs: the distinct keys in order, their common prefix lengths and smallest ids, and for each run the places of its entries among them."""
    runs = [decode_run(p, r) for p, r in zip(rows.column("prefix").to_pylist(), rows.column("rest").to_pylist(), strict=True)]
    docs = [np.frombuffer(unpack(d), np.int64) for d in rows.column("docs").to_pylist()]
    order, lcp = merge_runs(runs)
    order, lcp = np.array(order), np.array(lcp)
    seen = [np.flatnonzero(order == i) for i in range(len(runs))] if len(runs) < 8 else np.split(np.argsort(order, kind="stable"), np.cumsum([len(d) for d in docs])[:-1])
    doc = np.empty(len(order), np.int64)
    flat = np.empty((len(order), WIDTH), np.uint8)
    for at, d, (keys, _) in zip(seen, docs, runs, strict=True):
        doc[at] = d
        flat[at] = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, WIDTH)
    first = np.flatnonzero(lcp < WIDTH)
    entry = np.cumsum(lcp < WIDTH) - 1
    return flat[first], lcp[first], np.minimum.reduceat(doc, first), [entry[at] for at in seen]


def _answer(rows: pa.Table, least: np.ndarray, places: list[np.ndarray]) -> pa.Table:
    """To each run, the smallest ids of its entries' strings."""
    least = np.diff(least, axis=1, prepend=np.int64(0))  # repeats compress to nothing
    bits = [pack(np.ascontiguousarray(least[at].T).tobytes()) for at in places]
    return pa.table({"chunk": rows.column("chunk").cast(pa.int32()), "bucket": rows.column("bucket").cast(pa.int32()), "step": pa.array([2] * len(bits), pa.int32()), "bits": pa.array(bits, pa.binary())})


def _merge_bucket(rows: pa.Table) -> pa.Table:
    keys, lcp, docs, places = _merged(rows)
    return _answer(rows, smallest(keys, lcp, docs), places)


def _run_rows(number: int, keys: np.ndarray, docs: np.ndarray, lot: np.ndarray) -> tuple[pa.Table, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """A run for each lot that occurs, of sorted keys; the keys' order by lot, and the lots' bounds."""
    order = np.argsort(lot, kind="stable")
    held, cuts = groups(lot[order])
    out: dict[str, list] = {x.split()[0]: [] for x in RUN.split(", ")}
    for b, lo, hi in zip(held.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        at = order[lo:hi]
        for name, v in zip(out, (number, b, *encode_run(keys[at]), pack(docs[at].tobytes())), strict=True):
            out[name].append(v)
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds, strict=True)}), order, (held, cuts)


def _least_of(replies: pa.Table, n: int, order: np.ndarray, bounds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The answers to a run's keys, put together from those to its lots."""
    least = np.full((n, SPAN), _NONE)
    for b, bits in _by_step(replies, 2):
        i = int(np.searchsorted(bounds[0], b))
        at = order[bounds[1][i] : bounds[1][i + 1]]
        least[at] = np.cumsum(np.frombuffer(unpack(bits), np.int64).reshape(SPAN, len(at)), axis=0).T
    return least


def dedup(spark: SparkSession, docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_anchors: int = BUCKET_ANCHORS, top: int = TOP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_bytes (binary: cuts may fall within a character)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_bytes = text_bytes(docs)
    buckets = bucket_count(n_bytes // 14, bucket_anchors)
    merges = bucket_count(n_bytes // 14, bucket_anchors // 8)
    sent_to, wide, relay_chunks = min(buckets, top), buckets > top, max(1, 14 * bucket_anchors * top // chunk_bytes)
    dealt = chunked(docs, n_bytes, chunk_bytes)

    def mark(docs_: pa.Table) -> pa.Table:
        c = _Chunk(docs_)
        return _send(docs_.column("chunk")[0].as_py(), sent_to, c.h, np.ones(len(c.h), bool), None, wide)[0]

    def shared(c: _Chunk, replies: pa.Table) -> np.ndarray:
        _, rank, cuts = _send(0, sent_to, c.h, np.ones(len(c.h), bool), None, wide)
        return np.flatnonzero(_received(_by_step(replies, 1), cuts)[rank])

    below = max((merges - 1).bit_length() - (top - 1).bit_length(), 0)  # the bits of a lot that its part does not tell
    run_chunks = max(1, 14 * (bucket_anchors // 8) * top // chunk_bytes)

    def lots(h: np.ndarray) -> np.ndarray:
        return ((h >> _U(3)) % _U(merges)).astype(np.int64)

    def forward(rows: pa.Table) -> pa.Table:
        keys, _, docs_, _ = _merged(rows)
        grams = np.ascontiguousarray(keys[:, :GRAM]).view("<u8")
        return _run_rows(rows.column("relay")[0].as_py(), keys, docs_, lots(gram_hash(*grams.T)))[0]

    def back(rows: pa.Table, replies: pa.Table) -> pa.Table:
        keys, _, docs_, places = _merged(rows)
        grams = np.ascontiguousarray(keys[:, :GRAM]).view("<u8")
        _, order, bounds = _run_rows(0, keys, docs_, lots(gram_hash(*grams.T)))
        return _answer(rows, _least_of(replies, len(keys), order, bounds), places)

    def send_runs(_, docs_: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs_.num_rows:
            return _run_rows(0, np.zeros((0, WIDTH), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))[0]
        c = _Chunk(docs_)
        keys, h, least, _ = c.entries(shared(c, replies))
        return _run_rows(docs_.column("chunk")[0].as_py(), keys, least, lots(h) >> below)[0]

    def cut(_, docs_: pa.Table, replies: pa.Table) -> pa.Table:
        c = _Chunk(docs_)
        use = shared(c, replies)
        keys, h, _, rank = c.entries(use)
        lot = lots(h) >> below
        order = np.argsort(lot, kind="stable")
        least = _least_of(replies, len(keys), order, groups(lot[order]))
        number = np.full(len(c.anchors), -1)
        number[use] = rank
        entry = number[c.which]
        live = np.flatnonzero(entry >= 0)
        place, entry, anchor = c.places[live], entry[live], c.anchors[c.which[live]]
        owner = c.doc_ids[c.doc[c.which[live]]]
        found = place[least[entry, anchor - place] < owner]
        delta = np.zeros(c.n + 1, np.int32)
        np.add.at(delta, found, 1)
        np.add.at(delta, found + LENGTH, -1)
        gone = np.cumsum(delta[:-1]) > 0
        removed, spans, kept = [], [], []
        for s, e, text in zip(c.start.tolist(), c.end.tolist(), c.texts, strict=True):
            g = gone[s:e]
            n = int(g.sum())
            removed.append(n)
            spans.append(int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if n else 0)
            kept.append(np.frombuffer(text, np.uint8)[~g].tobytes() if n else text)
        return pa.table({"doc_id": pa.array(c.ids, pa.int64()), "n_bytes": pa.array((c.end - c.start).astype(np.int64)), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_bytes": pa.array(kept, pa.binary())})

    sent = dealt.groupBy("chunk").applyInArrow(mark, EXCHANGE)
    hits = answers(sent, 1, buckets, top, relay_chunks)
    runs = dealt.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(send_runs, RUN)
    if not below:
        found = runs.groupBy("bucket").applyInArrow(_merge_bucket, REPLY)
    else:
        relayed = runs.withColumn("relay", F.floor(F.col("chunk") / run_chunks).cast("int"))
        found = relayed.groupBy("relay", "bucket").applyInArrow(forward, RUN).groupBy("bucket").applyInArrow(_merge_bucket, REPLY)
        found = found.withColumn("relay", F.col("chunk")).withColumn("part", F.shiftright("bucket", below))
        found = relayed.groupBy("relay", "bucket").cogroup(found.groupBy("relay", "part")).applyInArrow(back, REPLY)
    return dealt.groupBy("chunk").cogroup(hits.unionByName(found).groupBy("chunk")).applyInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))
