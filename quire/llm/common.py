"""Shared pieces: table access, materialisation, chunking, small codecs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Table  # noqa: F401  the operators take it from here

#: ASCII white space: the complement of ``[^\x20\x09-\x0D]``.
SPACE_BYTES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
WORD_RE = r"[^\x20\x09-\x0D]+"

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slots(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, 1)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a column, from one pre-aggregated pass."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def chunked(df: DataFrame, n_bytes: int, chunk_bytes: int) -> DataFrame:
    """Add ``chunk``: rows dealt by a hash of doc_id and text, so that a chunk holds about chunk_bytes of text.

    The chunk depends on the row alone; a recomputed task deals the same rows. Rows that share an id (or have none)
    are spread by their texts.
    """
    n = max(1, -(-n_bytes // chunk_bytes))
    return df.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))


# ---- numpy kernels -------------------------------------------------------


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), element by element."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> _U(30))
        h = h * _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(27)
        h *= _U(0x94D049BB133111EB)
        h ^= h >> _U(31)
    return h


#: Words hashed at a time; and the bytes of a word whose numbers are looked up.
HASH_WORDS, NEAR = 1 << 14, 64

_SEP = np.zeros(256, bool)
_SEP[list(SPACE_BYTES)] = True


class Words:
    """The words of a list of texts: bounds in one buffer and the document of each."""

    def __init__(self, texts: list[bytes]):
        self.buf = b"\n".join(texts) + b"\n"
        arr = np.frombuffer(self.buf, np.uint8)
        solid = ~_SEP[arr]
        edge = np.diff(solid.view(np.int8), prepend=np.int8(0))
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        bounds = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.searchsorted(self.starts, bounds)]).astype(np.int64)
        self.arr, self.solid = arr, solid

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
        """One 64-bit hash a word: a polynomial in its bytes, finalised with its length.

        In pieces of HASH_WORDS words, so that the numbers a byte needs on the way are held for a piece only.
        """
        out = np.empty(len(self.starts), _U)
        if not len(out):
            return out
        sizes = self.ends - self.starts
        power = np.full(int(sizes.max()), _U(seed | 1))
        power[0] = 1
        power = np.multiply.accumulate(power)
        for lo in range(0, len(out), HASH_WORDS):
            starts, size = self.starts[lo : lo + HASH_WORDS], sizes[lo : lo + HASH_WORDS]
            begin, end = starts[0], starts[-1] + size[-1]
            at = np.flatnonzero(self.solid[begin:end])
            within = at - np.repeat(starts - begin, size)
            value = (self.arr[begin:end][at].astype(_U) + _U(1)) * power[within]
            out[lo : lo + HASH_WORDS] = np.add.reduceat(value, np.cumsum(size) - size) + size.astype(_U) * _U(0xD1B54A32D192ED03)
        return mix(out)

    def strong(self, seed: int) -> np.ndarray:
        """One 64-bit hash a word: the sum of one pseudo-random number for each byte and its place, finalised with the length.

        Two different words differ in a place, whose number is drawn for itself: their hashes are equal with probability 2^-64, whatever the
        words. Seeds give independent hashes.
        """
        out = np.empty(len(self.starts), _U)
        number = lambda at, byte: mix(mix(at.astype(_U) * _U(256) + byte.astype(_U)) ^ mix(np.array([seed], _U)))
        drawn = number(np.repeat(np.arange(NEAR), 256), np.tile(np.arange(256), NEAR))
        sizes = self.ends - self.starts
        for lo in range(0, len(out), HASH_WORDS):
            starts, size = self.starts[lo : lo + HASH_WORDS], sizes[lo : lo + HASH_WORDS]
            begin, end = starts[0], starts[-1] + size[-1]
            at = np.flatnonzero(self.solid[begin:end])
            within, byte = at - np.repeat(starts - begin, size), self.arr[begin:end][at]
            value = drawn[np.minimum(within, NEAR - 1) * 256 + byte]
            far = np.flatnonzero(within >= NEAR)
            value[far] = number(within[far], byte[far])
            out[lo : lo + HASH_WORDS] = np.add.reduceat(value, np.cumsum(size) - size) + mix(size.astype(_U) ^ _U(seed))
        return mix(out)

    def within(self, k: int) -> np.ndarray:
        """True where k words from here on are of one document."""
        ok = np.zeros(len(self.starts), bool)
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(ok))
        ok[:] = left >= k
        return ok


def rolling(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """The hash of every k consecutive values, by doubling; shorter by k - 1."""
    if len(h) < k:
        return np.zeros(0, _U)
    out, size, part, width, power = None, 0, h, 1, np.array([base | 1], _U)  # an array: its products wrap without a warning
    while True:
        if k & width:
            n = len(h) - (size + width) + 1
            out = part[:n].copy() if out is None else out[:n] * power + part[size : size + n]
            size += width
        if size == k:
            return out
        n = len(part) - width
        part = part[:n] * power + part[width : width + n]
        power, width = power * power, width * 2


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned integers, as compressed differences."""
    gaps = np.diff(values, prepend=values.dtype.type(0))
    planes = gaps.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.cumsum(np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel(), dtype=dtype)


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31)


def utf8(column: pa.ChunkedArray) -> list[bytes]:
    """The column's strings as bytes; null is empty."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


# ---- connected components ------------------------------------------------


#: Edge sets up to this many are solved in one task; larger ones by star rounds.
ONE_TASK_EDGES = 15_000


def _solve(rows: pa.Table) -> pa.Table:
    """(node, root) of a bounded set of edges, by union and find."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(rows.column("a").to_pylist(), rows.column("b").to_pylist(), strict=True):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return pa.table({"node": pa.array(list(root), pa.int64()), "root": pa.array([find(x) for x in root], pa.int64())})


def components(spark: SparkSession, edges: DataFrame, one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """(node, root): the smallest node reachable, for every node on an edge (a, b).

    Up to ``one_task`` edges are solved in one task. More go through alternating large-star and small-star rounds until
    nothing changes; each round is two aggregations over the edges, written to the shared folder. Null ends are dropped.
    """
    now = Table(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    n = now.df.count()
    if n <= one_task:
        return now.df.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(_solve, "node long, root long")
    while True:
        both = now.df.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.df.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_low, "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        then = Table(spark, small)
        m = then.df.count()
        same = m == n and then.df.exceptAll(now.df).isEmpty()
        now.drop()
        now, n = then, m
        if same:
            break
    stars = now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
