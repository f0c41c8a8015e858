"""Near copies by word shingles: components of texts whose shingle sets have a Jaccard similarity of 0.8 or more.

Candidates come first from SimHash: fingerprints of the shingle sets, compared in tiles by ``links`` (the grid of ``simhash``). A
64-bit SimHash has no radius that holds all such pairs (at 0.8 they lie up to 17 bits apart), so what it leaves out comes
from ``BANDS`` bands of ``ROWS`` min-hashes over the same shingles. Two texts at similarity s share no band
with probability (1 - s ** ROWS) ** BANDS: 7e-5 at 0.8, 2e-9 at 0.9. Every link is confirmed on the whole shingle sets.

All work is on distinct texts, named by their XXH64. Texts are told apart by a second hash: where two of one name differ in
it (about three names in 10^10 texts), that name is torn, and its texts stay out of the components instead of being taken for one. In each band every text is first held against the band's smallest
name, a star instead of all pairs. Where a band's texts then lie in different components, they are compared within tasks, and only
the links that join components leave a task, fewer than it has texts: no list of pairs is made. A band of over ``2 * TILE``
texts is dealt as pairs of tiles; the tiles of its largest component do not meet one another. In a task a pair is compared only in
the first band it shares, if its shingle counts allow the similarity and at least ``SKETCH_LEAST`` of its BANDS * ROWS
min-hashes agree (a pair at 0.8 has fewer with probability 1e-5), the most promising first, and not once its components are one; the comparison is of the whole
shingle sets. Frequent bands and names meet their other side by broadcast, as in ``simhash``: there are HOT_PARTS of them at most.

Words are those of the fingerprint: ASCII case folded, split at ASCII white space. A text of fewer than five words is
one shingle; texts without words are copies of each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Table, Words, components, mix, rolling

SIZE, BANDS, ROWS = 5, 24, 5
#: Shingle sets are alike from NUM / DEN on.
NUM, DEN = 4, 5
HOT_PARTS = 1000
TILE, SKETCH_LEAST = 1000, 76
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = 0x9E3779B97F4A7C15
#: Fixed odd factors, one a min-hash.
_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(text: bytes, size: int = SIZE) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles."""
    h = Words([text.translate(_LOWER)]).strong(_BASE)
    if not len(h):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        return np.unique(mix(rolling(h, min(size, len(h)), _BASE)))


def fingerprint(s: np.ndarray) -> int:
    """SimHash of a shingle set: a bit is set if it is set in over half of the hashes."""
    counts, step = np.zeros(64, np.int64), 1 << 14
    for i in range(0, len(s), step):
        counts += np.unpackbits(s[i : i + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(s), bitorder="little").view(np.uint64)[0])


def min_hashes(s: np.ndarray) -> np.ndarray:
    low = np.zeros(len(_FACTORS), np.uint64)
    if len(s):
        low = np.concatenate([(s[None, :] * f[:, None]).min(1) for f in np.split(_FACTORS, BANDS)])
    return low


def bands(low: np.ndarray) -> list[int]:
    """A key for each band of the min-hashes, its number included."""
    return [xxhash.xxh64_intdigest(x.tobytes(), i) for i, x in enumerate(low.reshape(BANDS, ROWS))]


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    n = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * n >= NUM * (len(a) + len(b) - n)


def name() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def second_name() -> F.Column:
    """Independent of the name; with it 128 bits tell texts apart."""
    return F.xxhash64(F.lit("second"), F.coalesce("text", F.lit("")))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
        fp = np.array([fingerprint(s) for s in sets], np.uint64)
        keys = np.array([bands(min_hashes(s)) for s in sets], np.uint64).reshape(len(sets), BANDS).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.select(["doc_id", "node", "other"]).columns, pa.array([len(s) for s in sets], pa.int64()), pa.array(fp.view(np.int64)), pa.array(list(keys), pa.list_(pa.int64()))], names=["doc_id", "node", "other", "n", "fp", "keys"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b"))
        held: tuple = (None, None)
        good = []
        for x, y in zip(one, two, strict=True):
            if held[0] != x:
                held = (x, shingles(x or b""))
            good.append(alike(held[1], shingles(y or b"")))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
        low = [min_hashes(s) for s in sets]
        cols = [pa.array([np.array(bands(x), np.uint64).tobytes() for x in low], pa.binary()), pa.array([(x >> np.uint64(20)).astype(np.uint8).tobytes() for x in low], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("node"), *cols], names=["node", "keys", "sketch", "set"])


def join_components(rows: pa.Table) -> pa.Table:
    """Links (a, b) that join the components of the texts of one band, or of two of its tiles; found by comparing sets."""
    side = rows.column("side").to_numpy()
    nodes, roots = rows.column("node").to_pylist(), rows.column("root").to_pylist()
    keys = np.frombuffer(b"".join(rows.column("keys").to_pylist()), np.int64).reshape(-1, BANDS)
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("set").to_pylist()]
    size = np.array([len(x) for x in sets])
    band = int(np.flatnonzero(keys[0] == rows.column("key")[0].as_py())[0])
    number = np.unique(np.array(roots, np.int64), return_inverse=True)[1]  # of the component of each text, kept up to date
    out: list[tuple[int, int]] = []
    right = np.flatnonzero(side == 1)
    common = number == np.bincount(number).argmax()  # the largest component as it is now: linked within, so met from the other side only
    for i in np.flatnonzero(side == 0).tolist():
        if not len(right) and common[i]:
            continue
        other = right if len(right) else np.flatnonzero((np.arange(len(nodes)) > i) | common)
        other = other[number[other] != number[i]]
        other = other[(np.minimum(size[other], size[i]) * DEN >= np.maximum(size[other], size[i]) * NUM)]
        if band:
            other = other[~(keys[other, :band] == keys[i, :band]).any(1)]
        agree = (sketch[other] == sketch[i]).sum(1)
        near = agree >= SKETCH_LEAST
        for j in other[near][np.argsort(-agree[near], kind="stable")].tolist():
            if number[i] != number[j] and alike(sets[i], sets[j]):
                out.append((nodes[i], nodes[j]))
                number[number == number[j]] = number[i]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def deal(mixed: DataFrame, tile: int) -> DataFrame:
    """key, i, j, side, node, root: the rows of a task; a large band's tiles meet in pairs, those of its largest component only the others."""
    sizes = mixed.groupBy("key", "root").count().groupBy("key").agg(F.max(F.struct("count", "root")).alias("m"), F.sum("count").alias("total"))
    tiles = lambda n: F.greatest(F.lit(1), F.ceil(n / tile)).cast("int")
    sizes = sizes.select("key", "total", F.col("m.root").alias("most"), tiles(F.col("total") - F.col("m.count")).alias("s0"), tiles(F.col("m.count")).alias("s1"))
    rows = mixed.join(sizes, "key")
    none = F.lit(0)
    small = rows.where(F.col("total") <= 2 * tile).select("key", none.alias("i"), none.alias("j"), none.alias("side"), "node", "root")
    large = rows.where(F.col("total") > 2 * tile)
    at = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    rest = large.where("root <> most").withColumn("t", at("s0"))
    left = rest.select("key", F.col("t").alias("i"), F.explode(F.sequence("t", F.col("s0") + F.col("s1") - 1)).alias("j"), none.alias("side"), "node", "root")
    right = rest.where("t > 0").select("key", F.explode(F.sequence(none, F.col("t") - 1)).alias("i"), F.col("t").alias("j"), F.lit(1).alias("side"), "node", "root")
    most = large.where("root = most").withColumn("t", at("s1"))
    most = most.select("key", F.explode(F.sequence(none, F.col("s0") - 1)).alias("i"), (F.col("s0") + F.col("t")).alias("j"), F.lit(1).alias("side"), "node", "root")
    return small.unionByName(left).unionByName(right).unionByName(most)


def meet(left: DataFrame, right: DataFrame, key: str, count: str, least: float) -> DataFrame:
    """An inner join on key, unique in right; keys with over ``least`` rows in left (``count``, a column of right) by broadcast."""
    hot = right.where(F.col(count) > least)
    cold = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right.where(F.col(count) <= least), key)
    return left.join(F.broadcast(hot), key).unionByName(cold)


def possible(n: F.Column, m: F.Column) -> F.Column:
    """Whether sets of n and m shingles can be alike."""
    return F.least(n, m) * DEN >= F.greatest(n, m) * NUM


def by_fingerprint(spark: SparkSession, nodes: DataFrame, links: Callable[[DataFrame], DataFrame], hot_parts: int) -> DataFrame:
    """Pairs (a, b) of nodes (node, n, fp): each with the smallest one of its fingerprint, and the smallest ones of fingerprints that are linked."""
    least = nodes.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("least"), F.count("*").alias("size"))
    least = Table(spark, least).df
    of_one = meet(nodes, least.where("size > 1"), "fp", "size", max(nodes.count() / hot_parts, 1)).where(F.col("node") > F.col("least.node"))
    of_one = of_one.select(F.col("least.node").alias("a"), F.col("least.n").alias("n_a"), F.col("node").alias("b"), F.col("n").alias("n_b"))
    side = lambda c: least.select(F.col("fp").alias(c), F.col("least.node").alias(f"node_{c}"), F.col("least.n").alias(f"n_{c}"))
    of_two = links(least.select("fp")).distinct().join(side("a"), "a").join(side("b"), "b")
    lo, hi = F.least("node_a", "node_b"), F.greatest("node_a", "node_b")
    of_two = of_two.select(lo.alias("a"), "n_a", hi.alias("b"), "n_b")  # the counts are only held against each other
    return of_one.unionByName(of_two).where(possible(F.col("n_a"), F.col("n_b"))).select("a", "b").distinct()


def cluster(spark: SparkSession, docs: DataFrame, hot_parts: int = HOT_PARTS, tile: int = TILE, links: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """node (a distinct text's name), first (its smallest doc_id), component (the component's smallest name; null if the name is torn).

    ``links`` gives the edges (a, b) between fingerprints (fp); without it the bands stand alone.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("node", name()).withColumn("other", second_name())
    sketched = docs.mapInArrow(_sketch, "doc_id long, node long, other long, n long, fp long, keys array<long>")
    torn = (F.min("other") < F.max("other")).alias("torn")
    distinct = Table(spark, sketched.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("keys").alias("keys"), torn))
    rows = distinct.df.where(~F.col("torn")).select("node", "n", F.explode("keys").alias("key"))
    groups = rows.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("node", "n")).alias("least")).where("size > 1")
    groups = Table(spark, groups).df
    least = max(distinct.df.count() / hot_parts, 1)
    rows = Table(spark, meet(rows, groups, "key", "size", least)).df  # rows of bands that are shared
    wanted = rows.select("node")
    if links:
        close = Table(spark, by_fingerprint(spark, distinct.df.where(~F.col("torn")).select("node", "n", "fp"), links, hot_parts)).df
        wanted = wanted.union(close.select("a")).union(close.select("b"))
    # Only these texts are compared; a text's copies are spread by their ids.
    wanted = wanted.distinct().join(distinct.df.select("node", "first"), "node")
    texts = docs.join(wanted, docs["node"].eqNullSafe(wanted["node"]) & docs["doc_id"].eqNullSafe(wanted["first"]), "left_semi")
    texts = Table(spark, texts.groupBy("node").agg(F.min("text").alias("text"))).df

    def confirm(pairs: DataFrame) -> Table:
        held = Table(spark, pairs)
        sizes = held.df.groupBy("a").agg(F.count("*").alias("pairs"))
        of_a = texts.withColumnsRenamed({"node": "a", "text": "text_a"}).join(sizes, "a")
        both = meet(held.df.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b"), of_a, "a", "pairs", max(held.df.count() / hot_parts, 1))
        return Table(spark, both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long"))

    star = rows.where((F.col("node") > F.col("least.node")) & possible(F.col("n"), F.col("least.n")))
    star = star.select(F.col("least.node").alias("a"), F.col("node").alias("b"))
    found = confirm((star.union(close) if links else star).distinct()).df
    stars = components(spark, found)
    at = rows.join(stars, "node", "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"))
    mixed = at.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.first("size").alias("size")).where("lo < hi")
    mixed = Table(spark, meet(at.drop("size"), mixed, "key", "size", least).select("key", "node", "root")).df
    sets = texts.join(mixed.select("node").distinct(), "node", "left_semi").mapInArrow(_sets, "node long, keys binary, sketch binary, set binary")
    more = deal(mixed, tile).join(sets, "node").groupBy("key", "i", "j").applyInArrow(join_components, "a long, b long")
    whole = components(spark, found.unionByName(more))
    component = F.when(~F.col("torn"), F.coalesce("root", "node")).alias("component")
    return distinct.df.select("node", "first", "torn").join(whole, "node", "left").select("node", "first", component)
