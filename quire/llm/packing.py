"""Packing by lexical retrieval.

A document is cut into whole windows of ``window`` tokens, sequences of their own, and a rest. Rests are sorted by a lexical
signature, so that rests which share rare terms lie next to one another, and the sorted row is cut into shards of about
``shard_docs``: first by range over tasks, then in runs within a task. The signature is three weighted min-hashes of a rest's
terms (a term's chance to be the minimum grows with the square of its inverse document frequency; terms of one rest only,
or of over ``COMMON_SHARE`` of all, are left out), so two rests agree on it the more likely the more rare terms they share, however large the
corpus is. A shard builds a BM25 inverted index over
the token ids of its rests (document frequencies and mean length over all rests of the corpus: vectors of the
vocabulary's size, the only things that are broadcast). A seed document's unused neighbours, best first,
fill its window; the last one is cut at the window's end, on a grid of ``grid`` tokens, and its remainder
seeds the next window. Only the last window of a shard can be short by more than the grid.

A text is tokenised once. What travels is small: term counts and the CRC-32 of the rest's prefixes on the grid,
from which the checksum of any cut follows (the CRC of a suffix is the whole's exclusive-or the shifted prefix's).

Cases: null and empty texts are one end token; very long texts are windows and one rest; repeated rows are
packed each on its own, also under one doc_id or none (the number of a row in the written table is its last sort key, so equal rows
are spread too); ties in score go to the earlier row of the shard; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Table, mix, slots

WINDOW, GRID, SHARD_DOCS, END_ID = 2048, 16, 1024, 1
K1, B = 1.2, 0.75
#: Terms of more rests than this share say little of a rest's subject.
COMMON_SHARE, SIGNATURE = 0.02, 3
TOKENIZER = "byte_bpe_50k.json"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class Tokens:
    """Token ids of a text by the tokenizer file at path.

    If the same vocabulary lies beside it as ranks, its faster encoder is used; texts with a special
    token's string go to the tokenizer itself, which alone maps it to one id.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


TOKEN_SCHEMA = "doc_id long, tokens long, whole array<long>, prefix binary, terms binary, counts binary"


def tokenise(docs: DataFrame, path: str, window: int = WINDOW, grid: int = GRID) -> DataFrame:
    """Per row: its tokens, the CRC of each whole window, the CRCs of the rest's prefixes, the rest's term counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path)
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text in batch.column("text").to_pylist():
                ids = np.append(tokens.ids(text or ""), np.uint32(END_ID)).astype("<u4")
                data, n = ids.tobytes(), len(ids)
                cut = n - n % window
                crc, prefix = 0, []
                for at in range(cut, n, grid):
                    crc = zlib.crc32(data[4 * at : 4 * min(at + grid, n)], crc)
                    prefix.append(crc)
                terms, counts = np.unique(ids[cut:], return_counts=True)
                row = (n, [zlib.crc32(data[4 * s : 4 * (s + window)]) for s in range(0, cut, window)], np.array(prefix, "<u4").tobytes(), terms.astype("<u4").tobytes(), counts.astype("<u2").tobytes())
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(out, kinds, strict=True)]], names=[x.split()[0] for x in TOKEN_SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, TOKEN_SCHEMA)


def frequencies(tokens: DataFrame, window: int) -> tuple[np.ndarray, int, float]:
    """How many rests have each token id, the number of rests and their mean length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, np.int64)
        for batch in batches:
            got = np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u4")
            n = int(got.max(initial=0)) + 1
            seen = np.pad(seen, (0, max(0, n - len(seen)))) + np.bincount(got, minlength=max(n, len(seen)))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["term", "n"])

    rows = tokens.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    out = np.zeros(max([r[0] for r in rows], default=0) + 1)
    for t, n in rows:
        out[t] = n
    size = F.col("tokens") % window
    total, rests = tokens.agg(F.sum(size), F.sum(F.when(size > 0, 1).otherwise(0))).first()
    return out, rests or 0, (total or 0) / max(rests or 0, 1)


_POWERS: list[list[int]] = []


def _times(matrix: list[int], v: int) -> int:
    out = i = 0
    while v:
        if v & 1:
            out ^= matrix[i]
        v >>= 1
        i += 1
    return out


def crc_shift(crc: int, n_bytes: int) -> int:
    """The share that a prefix's CRC-32 has in the CRC of the prefix and n_bytes more bytes."""
    if not _POWERS:
        m = [0xEDB88320, *[1 << i for i in range(31)]]  # one zero bit
        for _ in range(3):
            m = [_times(m, x) for x in m]
        _POWERS.append(m)
    k = 0
    while n_bytes >> k:
        if len(_POWERS) <= k:
            m = _POWERS[-1]
            _POWERS.append([_times(m, x) for x in m])
        if n_bytes >> k & 1:
            crc = _times(_POWERS[k], crc)
        k += 1
    return crc


class Index:
    """BM25 over the rests of one shard. Postings of rests that are used up go from time to time; that changes no other rest's score."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], lengths: np.ndarray, df: np.ndarray, n: int, mean: float):
        size = np.array([len(t) for t in terms])
        doc = np.repeat(np.arange(len(terms)), size)
        term = np.concatenate(terms).astype(np.int64)
        tf = np.concatenate(counts).astype(np.float64)
        idf = np.log1p((n - df[term] + 0.5) / (df[term] + 0.5))
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / max(mean, 1)))
        known, code = np.unique(term, return_inverse=True)
        order = np.argsort(code, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.start = np.searchsorted(code[order], np.arange(len(known) + 1))
        self.of = np.split(code, np.cumsum(size)[:-1])
        self.n = self.alive = len(terms)

    def compact(self, alive: np.ndarray) -> None:
        stay = alive[self.doc]
        self.start = np.concatenate([[0], np.cumsum(stay)])[self.start]
        self.doc, self.weight, self.alive = self.doc[stay], self.weight[stay], int(alive.sum())

    def scores(self, seed: int, left: np.ndarray | None = None) -> np.ndarray:
        """Every rest's score against a seed's terms; rests with nothing ``left`` may have any."""
        if left is not None and np.count_nonzero(left) < 0.8 * self.alive:
            self.compact(left > 0)
        t = self.of[seed]
        lo, size = self.start[t], self.start[t + 1] - self.start[t]
        at = np.arange(size.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def fill(lengths: np.ndarray, scores, window: int, grid: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length); scores(seed, left) ranks the documents that have something left for a seed."""
    left = lengths.copy()
    done = np.zeros(len(lengths), np.int64)
    out, pending, nxt = [], -1, 0
    while True:
        if pending >= 0:
            seed = pending
        else:
            while nxt < len(left) and not left[nxt]:
                nxt += 1
            if nxt == len(left):
                return out
            seed = nxt
        pending, room, row = -1, window, []
        take = min(int(left[seed]), room)
        row.append((seed, int(done[seed]), take))
        done[seed] += take
        left[seed] -= take
        room -= take
        if room >= grid:
            s = scores(seed, left)
            s[left == 0] = -1
            for d in np.argsort(-s, kind="stable"):
                if not left[d]:
                    break
                whole = left[d] <= room
                take = int(left[d]) if whole else room - room % grid
                row.append((int(d), int(done[d]), take))
                done[d] += take
                left[d] -= take
                room -= take
                if not whole:
                    pending = int(d)
                    break
                if room < grid:
                    break
        out.append(row)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def term_orders(df: np.ndarray, n: int) -> np.ndarray:
    """For each of SIGNATURE min-hashes, each term's value: the smallest of a rest's terms is chosen; infinite where a term can't be."""
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    useful = (df >= 2) & (df <= max(2, COMMON_SHARE * n))
    out = np.full((SIGNATURE, len(df)), np.inf)
    for i in range(SIGNATURE):
        h = mix(np.arange(len(df), dtype=np.uint64) + np.uint64((i + 1) << 32))
        u = ((h >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
        out[i, useful] = -np.log(u[useful]) / idf[useful] ** 2
    return out


def signature(terms: list[bytes], orders: np.ndarray) -> np.ndarray:
    """SIGNATURE chosen term ids a rest, -1 where it has no useful term."""
    out = np.full((len(terms), SIGNATURE), -1, np.int32)
    for i, data in enumerate(terms):
        t = np.frombuffer(data, "<u4")
        if len(t):
            values = orders[:, t]
            best = values.argmin(1)
            out[i] = np.where(np.isfinite(values.min(1)), t[best], -1)
    return out


def pack(spark: SparkSession, docs: DataFrame, path: str | None = None, window: int = WINDOW, grid: int = GRID, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece; sequences of at most window tokens."""
    held = Table(spark, tokenise(docs, path or default_tokenizer(), window, grid))
    df, n_rests, mean = frequencies(held.df, window)
    shared = spark.sparkContext.broadcast((df, term_orders(df, n_rests)))  # the vocabulary's size
    keys = [f"_t{i}" for i in range(SIGNATURE)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = signature(batch.column("terms").to_pylist(), shared.value[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(s[:, i]) for i in range(SIGNATURE)]], names=[*batch.schema.names, *keys])

    def shard(data: list[dict], number: int) -> list[tuple]:
        """The pieces of the rests of one shard; sequences are numbered on from number."""
        out: list[tuple] = []
        lengths = np.array([r["tokens"] % window for r in data])
        index = Index([np.frombuffer(r["terms"], "<u4") for r in data], [np.frombuffer(r["counts"], "<u2") for r in data], lengths, shared.value[0], n_rests, mean)
        prefix = [[0, *np.frombuffer(r["prefix"], "<u4").tolist()] for r in data]
        for row in fill(lengths, index.scores, window, grid):
            offset = 0
            for d, start, length in row:
                r, whole = data[d], lengths[d]
                end = prefix[d][-(-(start + length) // grid)]
                crc = end ^ crc_shift(prefix[d][start // grid], 4 * length) if start else end
                out.append((r["doc_id"], r["tokens"] - int(whole) + start, length, crc, r["tokens"], number, offset))
                offset += length
            number += 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting = TaskContext.get().partitionId() << 40, []
        names, kinds = [n.split()[0] for n in PIECES.split(", ")], [pa.int64()] * 7

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                for i, crc in enumerate(r["whole"]):
                    out.append((r["doc_id"], i * window, window, crc, r["tokens"], number, 0))
                    number += 1
                if r["tokens"] % window:
                    waiting.append(r)
            if out:
                yield batch_of(out)
            while len(waiting) >= 2 * shard_docs:
                out = shard(waiting[:shard_docs], number)
                waiting, number = waiting[shard_docs:], out[-1][5] + 1
                yield batch_of(out)
        cuts = [len(waiting) * i // 2 for i in range(3)] if len(waiting) > 1.5 * shard_docs else [0, len(waiting)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                out = shard(waiting[lo:hi], number)
                number = out[-1][5] + 1
                yield batch_of(out)

    n_shards, some = -(-held.df.count() // shard_docs), 4 * slots(spark)
    tasks = max(1, n_shards if n_shards <= some else max(some, n_shards // 8))
    signed = held.df.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(sign, f"{TOKEN_SCHEMA}, _row long, {', '.join(f'{k} int' for k in keys)}")
    return signed.repartitionByRange(tasks, *keys, "doc_id", "tokens", "_row").sortWithinPartitions(*keys, "doc_id", "tokens", "_row").drop(*keys, "_row").mapInArrow(run, PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: the pieces of all rows that are left, each row packed on its own; its cases are ``pack``'s."""
    return pack(spark, docs)
