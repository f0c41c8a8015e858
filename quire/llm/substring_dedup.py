"""Substring dedup by fixed-block anchors.

Index: the non-overlapping blocks of ``block`` words of every document. Probe: every rolling window of
``block`` words. With ``block = (window + 1) // 2`` any repeat of ``window`` words holds a whole block of either
copy, so a document's repeats all lie around its hits. Extension: a hit is extended by every window of ``window`` words that
holds it; those that are found again cover exactly the maximal repeats, and the words they cover go.
(A hit is not walked outwards pair by pair: in a group of m copies that would be m x m walks. The equality of its windows finds the
same maximal repeats from one entry a window and chunk.)

Windows are equal if two hashes of 64 bits are. Each is rolled over word hashes of its own, drawn byte by byte with a seed
of its own (``Words.strong``), so no two words share both but by chance, 2^-128 a pair. The anchors use the first one alone:
a false hit is extended in vain, nothing is removed for it.

Documents are dealt into chunks by a hash of their id. A chunk sends each hash once for each bucket of hash
space, sorted, as compressed differences, with a mark for "more than once here": however often a
passage repeats, it costs a bucket one entry a chunk. The bucket sends back one bit an entry.
The number of chunks and of buckets follows the input, so neither grows in memory. A chunk sends to ``top`` buckets at most: where more are
needed, relays stand between, each for one top bucket and as many chunks as make a bucket's entries together. A relay merges their
rows, sends on to the buckets below its own, and takes the answers apart again; so the rows of the exchange, and their number of entries, are in
proportion to the input also where chunks times buckets are not.

Cases: null and empty texts have no words and lose none (kept text is empty); texts shorter than a window
lose none; repeated rows are copies of one another, also under one doc_id (equal rows, id and all, share a chunk); an empty table gives no rows;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Words, chunked, mix, pack, pack_sorted, rolling, text_bytes, unpack, unpack_sorted, utf8

WINDOW, CHUNK_BYTES, BUCKET_WORDS, TOP = 35, 6 << 20, 2_000_000, 1024
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
EXCHANGE = "chunk int, bucket int, hash binary, check binary, marks binary"
REPLY = "chunk int, bucket int, step int, bits binary"
_U = np.uint64


def bucket_count(values: int, per_bucket: int) -> int:
    """A power of two: about per_bucket values a bucket."""
    return 1 << max(0, (max(values, 1) - 1) // per_bucket).bit_length()


Cuts = tuple[np.ndarray, np.ndarray]


def groups(sorted_numbers: np.ndarray) -> Cuts:
    """The numbers that occur and where each one's run starts, with the end at last: work follows the runs, not the range."""
    first = np.flatnonzero(np.diff(sorted_numbers, prepend=sorted_numbers[:1] - 1)) if len(sorted_numbers) else np.zeros(0, np.int64)
    return sorted_numbers[first], np.append(first, len(sorted_numbers))


def _rows(chunk: int, buckets: int, distinct: np.ndarray, check: np.ndarray | None, marks: np.ndarray, narrow: bool) -> tuple[pa.Table, Cuts]:
    """Sorted distinct hashes by bucket (the leading bits), a row for each that occurs; and the buckets' bounds."""
    width = int(buckets - 1).bit_length()
    held, cuts = groups((distinct >> _U(64 - width)).astype(np.int64) if width else np.zeros(len(distinct), np.int64))
    rows: dict[str, list] = {n.split()[0]: [] for n in EXCHANGE.split(", ")}
    for b, lo, hi in zip(held.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        part = distinct[lo:hi]
        if narrow:  # the 32 bits after the bucket's tell hashes apart well enough for candidates
            part = (part << _U(width) >> _U(32)).astype(np.uint32)
        for name, v in (("chunk", chunk), ("bucket", b), ("hash", pack_sorted(part)), ("check", b"" if check is None else check[lo:hi].tobytes()), ("marks", pack(np.packbits(marks[lo:hi].ravel()).tobytes()))):
            rows[name].append(v)
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table({n: pa.array(v, k) for (n, v), k in zip(rows.items(), kinds, strict=True)}), (held, cuts)


def _send(chunk: int, buckets: int, h: np.ndarray, block: np.ndarray | None, check: np.ndarray | None = None, wide: bool = False) -> tuple[pa.Table, np.ndarray, Cuts]:
    """A chunk's rows; also each value's place among the distinct ones, and the buckets' bounds. ``wide`` keeps all bits, for a relay."""
    order = np.lexsort((check, h)) if check is not None else np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    if check is not None:
        c = check[order]
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    rank = np.empty(len(h), np.int64)
    rank[order] = np.cumsum(new) - 1
    many = (np.diff(first, append=len(s)) > 1)[:, None]
    if block is not None:
        anchored = np.zeros(len(first), bool)
        anchored[rank[block]] = True
        many = np.concatenate([many, anchored[:, None]], 1)
    table, cuts = _rows(chunk, buckets, s[first], None if check is None else c[first], many, check is None and not wide)
    return table, rank, cuts


def _received(replies: list[tuple[int, bytes]], bounds: Cuts) -> np.ndarray:
    held, cuts = bounds
    hit = np.zeros(cuts[-1], bool)
    for b, bits in replies:
        i = int(np.searchsorted(held, b))
        n = cuts[i + 1] - cuts[i]
        hit[cuts[i] : cuts[i + 1]] = np.unpackbits(np.frombuffer(unpack(bits), np.uint8), count=n).astype(bool)
    return hit


class _Chunk:
    """The windows of a chunk's documents, in the order of their ids and texts."""

    def __init__(self, docs: pa.Table, window: int):
        ids, texts = docs.column("doc_id").to_pylist(), utf8(docs.column("text"))
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids, self.texts, self.order = [ids[i] for i in order], [texts[i] for i in order], order
        self.words, self.block = Words(self.texts), (window + 1) // 2
        self.h = self.words.strong(_BASES[0])
        inside = self.words.within(self.block)
        self.at = np.flatnonzero(inside)
        rolled = rolling(self.h, self.block, _BASES[0])
        self.roll = mix(rolled[self.at]) if len(self.at) else np.zeros(0, _U)
        start = np.repeat(self.words.first[:-1], np.diff(self.words.first))
        self.is_block = (self.at - start[self.at]) % self.block == 0 if len(self.at) else np.zeros(0, bool)

    def candidates(self, hit: np.ndarray, window: int) -> np.ndarray:
        """The starts of whole windows that hold a hit."""
        n = len(self.words)
        if not len(hit):
            return np.zeros(0, np.int64)
        delta = np.zeros(n + 1, np.int64)
        at = self.at[hit]
        np.add.at(delta, np.maximum(at - (window - self.block), 0), 1)
        np.add.at(delta, at + 1, -1)
        return np.flatnonzero((np.cumsum(delta[:-1]) > 0) & self.words.within(window))

    def windows(self, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(starts):
            return np.zeros(0, _U), np.zeros(0, _U)
        one = mix(rolling(self.h, window, _BASES[0])[starts] ^ _U(0x2545F4914F6CDD1D))
        return one, mix(rolling(self.words.strong(_BASES[1]), window, _BASES[1])[starts])


def _merged(rows: pa.Table, step: int, kind) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray, np.ndarray]:
    """Of several rows of one bucket: distinct hashes and checks, their marks together (more than once, is a block), each entry's place, the rows' sizes."""
    hashes = [unpack_sorted(x, kind) for x in rows.column("hash").to_pylist()]
    sizes = np.array([len(h) for h in hashes])
    all_h = np.concatenate(hashes)
    width = 2 if step == 1 else 1
    marks = np.concatenate([np.unpackbits(np.frombuffer(unpack(m), np.uint8), count=n * width) for m, n in zip(rows.column("marks").to_pylist(), sizes, strict=True)]).astype(bool).reshape(-1, width)
    check = None
    if step == 1:
        order = np.argsort(all_h, kind="stable")
    else:
        check = np.concatenate([np.frombuffer(c, _U) for c in rows.column("check").to_pylist()])
        order = np.lexsort((check, all_h))
        check = check[order]
    s = all_h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    if check is not None:
        new[1:] |= check[1:] != check[:-1]
    first = np.flatnonzero(new)
    place = np.empty(len(s), np.int64)
    place[order] = np.cumsum(new) - 1
    together = np.bitwise_or.reduceat(marks[order], first, axis=0)
    together[:, 0] |= np.diff(first, append=len(s)) > 1
    return s[first], None if check is None else check[first], together, place, sizes


def _answer(rows: pa.Table, step: int, bits: np.ndarray, sizes: np.ndarray) -> pa.Table:
    parts = [pack(np.packbits(p).tobytes()) for p in np.split(bits, np.cumsum(sizes)[:-1])]
    return pa.table({"chunk": rows.column("chunk").cast(pa.int32()), "bucket": rows.column("bucket").cast(pa.int32()), "step": pa.array([step] * len(parts), pa.int32()), "bits": pa.array(parts, pa.binary())})


def _probe_reply(rows: pa.Table, step: int) -> pa.Table:
    """For one bucket: a bit an entry, set if its hash is indexed by a block and found twice or more."""
    *_, marks, place, sizes = _merged(rows, step, np.uint32 if step == 1 else _U)
    return _answer(rows, step, marks.all(1)[place], sizes)


def answers(sent: DataFrame, step: int, buckets: int, top: int, relay_chunks: int) -> DataFrame:
    """What the buckets say to the rows that chunks have sent: a row of bits for each. Over ``top`` buckets it goes through relays."""
    if buckets <= top:
        return sent.groupBy("bucket").applyInArrow(lambda t: _probe_reply(t, step), REPLY)
    below = (buckets - 1).bit_length() - (top - 1).bit_length()

    def forward(rows: pa.Table) -> pa.Table:
        h, check, marks, _, _ = _merged(rows, step, _U)
        return _rows(rows.column("relay")[0].as_py(), buckets, h, check, marks, step == 1)[0]

    def back(rows: pa.Table, replies: pa.Table) -> pa.Table:
        h, check, marks, place, sizes = _merged(rows, step, _U)
        cuts = _rows(0, buckets, h, check, marks, step == 1)[1]
        return _answer(rows, step, _received(_by_step(replies, step), cuts)[place], sizes)

    relayed = sent.withColumn("relay", F.floor(F.col("chunk") / relay_chunks).cast("int"))
    replies = relayed.groupBy("relay", "bucket").applyInArrow(forward, EXCHANGE).groupBy("bucket").applyInArrow(lambda t: _probe_reply(t, step), REPLY)
    replies = replies.withColumn("relay", F.col("chunk")).withColumn("top", F.shiftright("bucket", below))
    return relayed.groupBy("relay", "bucket").cogroup(replies.groupBy("relay", "top")).applyInArrow(back, REPLY)


def _by_step(replies: pa.Table, step: int) -> list[tuple[int, bytes]]:
    rows = zip(replies.column("step").to_pylist(), replies.column("bucket").to_pylist(), replies.column("bits").to_pylist(), strict=True)
    return [(b, x) for s, b, x in rows if s == step]


def dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, bucket_words: int = BUCKET_WORDS, keep: tuple[str, ...] = (), top: int = TOP, whole: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words, one space between), and ``_keep_0``, ...: the row's own columns named in ``keep``.

    With ``whole`` the text as it came follows as ``text``; it travels once, so it is not to be named in ``keep``.
    """
    kept_as = [f"_keep_{i}" for i in range(len(keep))]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(c).alias(n) for c, n in zip(keep, kept_as, strict=True)])
    result = StructType([*StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_text string").fields, *docs.schema.fields[2:], *docs.schema.fields[1:2] * whole])
    n_bytes = text_bytes(docs)
    buckets = bucket_count(n_bytes // 6, bucket_words)
    sent_to, wide, relay_chunks = min(buckets, top), buckets > top, max(1, 6 * bucket_words * top // chunk_bytes)
    dealt = chunked(docs, n_bytes, chunk_bytes)

    def probe(docs_: pa.Table) -> pa.Table:
        c = _Chunk(docs_, window)
        return _send(docs_.column("chunk")[0].as_py(), sent_to, c.roll, c.is_block, None, wide)[0]

    def extend(_, docs_: pa.Table, replies: pa.Table) -> pa.Table:
        c = _Chunk(docs_, window) if docs_.num_rows else None
        if c is None:
            return pa.table({n.split()[0]: pa.array([], k) for n, k in zip(EXCHANGE.split(", "), (pa.int32(), pa.int32(), *[pa.binary()] * 3), strict=True)})
        _, rank, cuts = _send(0, sent_to, c.roll, c.is_block, None, wide)
        starts = c.candidates(_received(_by_step(replies, 1), cuts)[rank], window)
        one, two = c.windows(starts, window)
        return _send(docs_.column("chunk")[0].as_py(), sent_to, one, None, two)[0]

    def cut(_, docs_: pa.Table, replies: pa.Table) -> pa.Table:
        c = _Chunk(docs_, window)
        _, rank, cuts = _send(0, sent_to, c.roll, c.is_block, None, wide)
        starts = c.candidates(_received(_by_step(replies, 1), cuts)[rank], window)
        one, two = c.windows(starts, window)
        _, rank2, cuts2 = _send(0, sent_to, one, None, two)
        found = starts[_received(_by_step(replies, 2), cuts2)[rank2]] if len(starts) else starts
        delta = np.zeros(len(c.words) + 1, np.int64)
        np.add.at(delta, found, 1)
        np.add.at(delta, found + window, -1)
        gone = np.cumsum(delta[:-1]) > 0
        kept, n_removed, first = [], [], c.words.first
        starts_, ends_, buf = c.words.starts, c.words.ends, c.words.buf
        for i in range(len(c.ids)):
            lo, hi = first[i], first[i + 1]
            stay = np.flatnonzero(~gone[lo:hi]) + lo
            n_removed.append(int(hi - lo - len(stay)))
            kept.append(b" ".join([buf[a:b] for a, b in zip(starts_[stay].tolist(), ends_[stay].tolist(), strict=True)]))
        own = docs_.select([*kept_as, *["text"] * whole]).take(pa.array(c.order, pa.int64()))
        return pa.table({"doc_id": pa.array(c.ids, pa.int64()), "n_words": pa.array(np.diff(first).astype(np.int64)), "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())} | {n: own.column(n) for n in own.column_names})

    sent = dealt.groupBy("chunk").applyInArrow(probe, EXCHANGE)
    hits = answers(sent, 1, buckets, top, relay_chunks)
    sent2 = dealt.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(extend, EXCHANGE)
    more = answers(sent2, 2, buckets, top, relay_chunks)
    return dealt.groupBy("chunk").cogroup(hits.unionByName(more).groupBy("chunk")).applyInArrow(cut, result)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: repeated passages are cut from the texts; a document with none stays as it is.

    Every row travels with its own columns, so nothing is joined back by id. Cases: rows that share an id with different
    texts each keep their own; rows without an id are cut like any other; a null text stays null; repeated rows are
    copies of one another and lose what they share; an empty table gives no rows; very long texts are one row of a chunk.
    """
    names = docs.columns
    others = tuple(c for c in names if c != "text")
    out = dedup(spark, docs, keep=others, whole=True)
    cut, whole = F.col("n_removed") > 0, {c: F.col(f"_keep_{i}") for i, c in enumerate(others)} | {"text": F.col("text")}
    text = F.when(cut, F.col("kept_text")).otherwise(whole["text"])
    changed = {"text": text, "n_chars": F.when(cut, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(whole["n_chars"]) if "n_chars" in whole else None}
    return out.select(*[(changed.get(c) if c in ("text", "n_chars") else whole[c]).alias(c) for c in names])
