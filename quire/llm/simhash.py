"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: bit i is set if it is set in over half of the XXH64 hashes of the shingles. All later work
is on distinct fingerprints with their smallest doc_id; copies never meet.

The plan is a grid of tiles. Fingerprints are grouped by a key prefix, sorted by population count within it and laid out in tiles;
a tile pair whose population counts differ by more than the radius is skipped, every other pair of tiles is
compared whole by numpy exclusive-or and bit counts. The key prefix is the grid's pruning, which keeps the comparisons from growing
with the square of the corpus: two fingerprints within radius r agree on one of r + 1 bit blocks, so there is a
grid for each block, over the first bits of the block, as many as make about ``GROUP`` fingerprints a prefix. Where one block
is too short for that (from about 70 million distinct fingerprints on), the prefix is taken over each pair of r + 2 blocks, two of
which agree. Neither loses a link. A prefix over ``split`` fingerprints is dealt as tile pairs over tasks, those out of reach by
population count left out, so that no task holds it whole. From a tile pair only a spanning forest of its links is kept (as many
edges as fingerprints at most), and components are found over those edges.

Cases: null and empty texts have fingerprint zero and are linked like any other; a null doc_id row
keeps its fingerprint and its component is the smallest known id; repeated rows come back as often as they are
given; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import near_copies
from .common import WORD_RE, Table, components, fresh

RADIUS, SHINGLE, TILE, GROUP, SPLIT = 3, 3, 128, 1024, 4096
#: A fingerprint with over this part of all rows joins by broadcast; there are HOT_PARTS of them at most.
HOT_PARTS = 1000
#: The pipeline's stage: a wider radius, and larger groups, so that single blocks serve up to 2 million texts.
STAGE_RADIUS, STAGE_GROUP, STAGE_SPLIT = 7, 8192, 32768
_WORDS = re.compile(WORD_RE.encode())
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    words = _WORDS.findall(text.translate(_LOWER))
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= size:
        return hash_of(b" ".join(words), 42)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    ends = (starts + sizes)[size - 1 :].tolist()
    counts, n = np.zeros(64, np.int64), len(ends)
    step = 1 << 16
    starts = starts.tolist()
    for i in range(0, n, step):
        h = np.array([hash_of(joined[a:b], 42) for a, b in zip(starts[i : min(i + step, n)], ends[i : i + step], strict=True)], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int, tile: int = TILE) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Index pairs within the radius, of a with itself (b None) or with b, both sorted by population count; tile pairs compared and skipped."""
    same = b is None
    b = a if b is None else b
    left, right, compared, skipped = [], [], 0, 0
    pa_, pb = np.bitwise_count(a).astype(int), np.bitwise_count(b).astype(int)
    for i in range(0, len(a), tile):
        x = a[i : i + tile]
        lo, hi = pa_[i], pa_[min(i + tile, len(a)) - 1]
        for j in range(i if same else 0, len(b), tile):
            if pb[j] > hi + radius or pb[min(j + tile, len(b)) - 1] < lo - radius:
                skipped += 1
                continue
            compared += 1
            u, v = np.nonzero(np.bitwise_count(x[:, None] ^ b[None, j : j + tile]) <= radius)
            left.append(u + i)
            right.append(v + j)
    u, v = (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))
    return (u[u < v], v[u < v], compared, skipped) if same else (u, v, compared, skipped)


def forest(n: int, u: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links, by union and find."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def bit_blocks(count: int) -> list[tuple[int, int]]:
    """(first bit, size) of count blocks that make up the 64 bits."""
    cuts = [64 * i // count for i in range(count + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def prefixes(n: int, radius: int, group: int = GROUP) -> tuple[list[tuple[tuple[int, int], ...]], int]:
    """The grids of n fingerprints: the blocks of each one's key, and how many bits of the key are its prefix."""
    bits = max(0, (max(n, 1) - 1) // group).bit_length()
    single = [(x,) for x in bit_blocks(radius + 1)]
    if not bits:
        return single[:1], 0  # all in one group
    if bits <= min(size for ((_, size),) in single):
        return single, bits
    pairs = list(combinations(bit_blocks(radius + 2), 2))
    return pairs, min(bits, *(sum(size for _, size in p) for p in pairs))


def links(distinct: DataFrame, radius: int = RADIUS, split: int = SPLIT, group: int = GROUP, tile: int = TILE, counters: tuple | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all within the radius; distinct has fp.

    ``counters`` are two accumulators: tile pairs compared and tile pairs skipped.
    """
    grids, bits = prefixes(distinct.count(), radius, group)
    keys = []
    for i, blocks in enumerate(grids):
        key, size = F.lit(0).cast("long"), 0
        for at, n in blocks:
            key, size = F.shiftleft(key, n).bitwiseOR(F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1))), size + n
        keys.append(F.shiftrightunsigned(key, size - bits) * F.lit(len(grids)) + F.lit(i))
    grouped = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = grouped.groupBy("key").count().where("count > 1")
    grouped = grouped.join(sizes, "key")
    small = grouped.where(F.col("count") <= split).select("key", "fp", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"))
    # A large group: tiles of about split / 2 fingerprints by population count and hash, dealt as pairs.
    pop = F.bit_count("fp").cast("int")
    slices = F.greatest(F.lit(1), F.ceil(F.col("count") / F.lit(split * 2))).cast("int")
    large = grouped.where(F.col("count") > split).withColumn("t", pop * slices + F.pmod(F.xxhash64("fp"), slices).cast("int")).withColumn("slices", slices).withColumn("pop", pop)
    tiles = large.select("key", "pop", "slices", "t").distinct()
    other = tiles.select("key", F.col("pop").alias("pop2"), F.col("t").alias("t2"))
    # The tiles of a key number 65 x slices at most: pairs of tiles, not of rows, and only within the radius.
    near = tiles.join(other, "key").where((F.col("t") <= F.col("t2")) & (F.col("pop2") - F.col("pop") <= radius))
    sides = near.select("key", F.col("t").alias("i"), F.col("t2").alias("j"))
    first = large.withColumn("i", F.col("t")).join(sides, ["key", "i"]).select("key", "fp", "i", "j", F.lit(0).alias("side"))
    second = large.withColumn("j", F.col("t")).join(sides.where("i <> j"), ["key", "j"]).select("key", "fp", "i", "j", F.lit(1).alias("side"))

    def run(_, rows: pa.Table) -> pa.Table:
        fp = rows.column("fp").to_numpy().view(np.uint64)
        side = rows.column("side").to_numpy()
        parts = [np.unique(fp[side == s]) for s in (0, 1)]
        parts = [p[np.argsort(np.bitwise_count(p), kind="stable")] for p in parts]
        u, v, compared, skipped = tile_links(parts[0], parts[1] if len(parts[1]) else None, radius, tile)
        if counters:
            counters[0].add(compared)
            counters[1].add(skipped)
        both = np.concatenate(parts).view(np.int64)
        if len(parts[1]):
            v = v + len(parts[0])  # a second side comes after the first
        edges = forest(len(both), u, v)
        return pa.table({"a": pa.array([both[x] for x, _ in edges], pa.int64()), "b": pa.array([both[y] for _, y in edges], pa.int64())})

    dealt = small.unionByName(first).unionByName(second)
    return dealt.groupBy("key", "i", "j").applyInArrow(lambda k, t: run(k, t), "a long, b long")


def cluster(spark: SparkSession, docs: DataFrame, radius: int = RADIUS, hot_parts: int = HOT_PARTS) -> DataFrame:
    """doc_id, fp, component_id of every row of docs.

    Rows meet their fingerprint's component by a shuffled join, but for fingerprints with over one row in
    ``hot_parts``: fewer than that many fingerprints, whatever the input, and broadcast.
    """
    held = Table(spark, fingerprints(docs))
    distinct = Table(spark, held.df.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))).df
    found = components(spark, links(distinct, radius))
    roots = distinct.join(found, distinct["fp"] == found["node"]).select("fp", "first", "root")
    least = roots.groupBy("root").agg(F.min("first").alias("component"))
    moved = roots.join(least, "root").select("fp", "component")
    ids = distinct.join(moved, "fp", "left").select("fp", "copies", F.coalesce("component", "first").alias("component_id"))
    ids = Table(spark, ids).df
    hot = F.col("copies") > held.df.count() / hot_parts
    often = F.broadcast(ids.where(hot).drop("copies"))
    cold = held.df.join(F.broadcast(ids.where(hot).select("fp")), "fp", "left_anti").join(ids.where(~hot).drop("copies"), "fp")
    return held.df.join(often, "fp").unionByName(cold).select("doc_id", "fp", "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cluster(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: one document of each component of near copies stays, the one with the smallest doc_id.

    The stage links texts by its own threshold, 0.8 on five-word shingles (see ``near_copies``): fingerprints within ``STAGE_RADIUS``
    by the query's tiles, confirmed, and what lies further apart by bands; the radius of 3 bits is the query's. Rows are judged by their texts: rows without an id are copies like any other and go before rows
    with one, and rows that share an id with different texts are told apart.
    """
    nodes = Table(spark, near_copies.cluster(spark, docs, links=lambda fps: links(fps, STAGE_RADIUS, STAGE_SPLIT, STAGE_GROUP))).df
    order = F.struct(F.col("first").isNull().alias("none"), "first", "node")
    node, first, mine, other = (fresh(docs, f"_quire_{n}") for n in ("node", "first", "name", "other"))
    keep = nodes.where("component is not null").groupBy("component").agg(F.min(order).alias("k")).select(F.col("k.node").alias(node), F.col("k.first").alias(first))
    torn = nodes.where("component is null").select(F.col("node").alias(node))  # two texts of one name: all their rows stay
    named = docs.withColumn(mine, near_copies.name()).withColumn(other, near_copies.second_name())
    same = (named[mine] == keep[node]) & named["doc_id"].cast("long").eqNullSafe(keep[first])
    stay = named.join(keep, same, "left_semi")
    if not torn.isEmpty():
        stay = stay.unionByName(named.join(torn, named[mine] == torn[node], "left_semi"))
    return stay.dropDuplicates([mine, other]).select(*docs.columns)
