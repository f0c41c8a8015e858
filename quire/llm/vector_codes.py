"""Vector code compression: product quantisation in whole numbers, screened in float32 and decided exactly.

A vector's components become integers, floor(256 x), and the vector is cut into ``parts`` consecutive parts. Each part has a
codebook of ``entries`` entries; a part's code is its nearest entry by squared Euclidean distance, ties to the lower index.

Nearest entries: for a batch, the scores |c|^2 - 2 v.c of all entries come from one float32 matrix product. With unit
roundoff u = 2^-24, converting v and c costs a relative u each, a sum of d products d u more in whatever order it is done (fused
or not), and the two last operations u each; so the computed score lies within (d + 8) 2u (|c|^2 + 2 |v| |c|) of the true one
(norms in float64). An entry whose interval reaches down to the lowest upper end may be the nearest: where that is one entry it
is, otherwise all of them are computed in int64 and the lowest exact distance wins, then the lower index.

Training: the codebooks start as the parts of the first vectors by id. A round assigns every vector in its task and
sends one row of sums and counts an entry and task, which Spark adds up; the driver sees the entries' sums only (parts x
entries x part width numbers, whatever the input), and the tasks the codebooks.

Cases: a vector that is null, or holds null or non-finite components, is dropped; so is one that is not of the space: the space's
width is the most frequent length that the parts divide (the longer one on a tie). Integers are exact up to 2^28 in magnitude (|x| < 2^20),
so that squared distances fit int64; a vector beyond that is dropped too. Vectors that share an id, or have none, are rows like any
other; as first entries, null ids come last, and ties go by the vector. With fewer vectors than entries there are fewer entries. An
entry without vectors stays as it is. Null labels are one label. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Table

PARTS, ENTRIES, ROUNDS, SCALE, LIMIT = 16, 64, 2, 256, 1 << 28
#: Vectors compared at a time.
BATCH = 4096
#: A label with over this part of all rows joins by broadcast; there are HOT_PARTS of them at most.
HOT_PARTS = 1000


def kept(vectors: DataFrame, parts: int = PARTS, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, int]:
    """vec_id, vector and label of the usable rows, and the width of their space (0 without any)."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    good = F.col("vector").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0)
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT / SCALE)  # noqa: E731  infinity is beyond the limit
    rows = rows.where(good & F.forall("vector", fits))
    best = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = best["width"] if best else 0
    return rows.where(F.size("vector") == width), width


def integers(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return np.floor(flat.astype(np.float64) * SCALE).astype(np.int64)


class Codebook:
    """One part's entries, ready for screening."""

    def __init__(self, entries: np.ndarray):
        self.exact = entries
        self.f32 = entries.astype(np.float32)
        square = (entries.astype(np.float64) ** 2).sum(1)
        self.square32, self.square, self.norm = (entries**2).sum(1).astype(np.float32), square, np.sqrt(square)

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index of the nearest entry and its squared distance for every row of v, and how many rows the screen left open."""
        slack = (v.shape[1] + 8) * 2.0**-23 * (1 + 2.0**-20)  # the last factor covers the float64 norms
        index, distance, open_rows = np.empty(len(v), np.int64), np.empty(len(v), np.int64), 0
        for lo in range(0, len(v), BATCH):
            x = v[lo : lo + BATCH]
            score = (self.square32 - 2 * (x.astype(np.float32) @ self.f32.T)).astype(np.float64)
            norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
            error = slack * (self.square + 2 * norm[:, None] * self.norm)
            maybe = score - error <= (score + error).min(1)[:, None]
            best = maybe.argmax(1)
            again = np.flatnonzero(maybe.sum(1) > 1)
            if len(again):
                row, entry = np.nonzero(maybe[again])  # by row, then by index
                exact = ((x[again][row] - self.exact[entry]) ** 2).sum(1)
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                low = np.minimum.reduceat(exact, begin)
                tied = np.flatnonzero(exact == low[row])
                best[again] = entry[tied[np.flatnonzero(np.diff(row[tied], prepend=-1))]]
                open_rows += len(again)
            index[lo : lo + BATCH] = best
            distance[lo : lo + BATCH] = ((x - self.exact[best]) ** 2).sum(1)
        return index, distance, open_rows


def start(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The first codebooks, parts x entries x part width: a bounded number of vectors by id."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).collect()
    whole = np.floor(np.array([r[0] for r in first], np.float64).reshape(len(first), width) * SCALE).astype(np.int64)
    return whole.reshape(len(first), parts, width // parts).transpose(1, 0, 2)


def improved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry the floor of its parts' mean, by component."""
    parts, entries, size = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Codebook(b) for b in books]
        total, count = np.zeros((parts * entries, size), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            v = integers(batch.column(0), parts * size)
            for p, book in enumerate(held):
                x = v[:, p * size : (p + 1) * size]
                at = book.nearest(x)[0] + p * entries
                np.add.at(total, at, x)
                count += np.bincount(at, minlength=parts * entries)
        used = np.flatnonzero(count)
        cols = [pa.array(used), pa.array(count[used]), *[pa.array(total[used, i]) for i in range(size)]]
        yield pa.RecordBatch.from_arrays(cols, names=["slot", "n", *[f"s{i}" for i in range(size)]])

    names = [f"s{i}" for i in range(size)]
    schema = ", ".join(f"{n} long" for n in ["slot", "n", *names])
    added = rows.select("vector").mapInArrow(sums, schema).groupBy("slot").agg(*[F.sum(n).alias(n) for n in ["n", *names]])
    out = books.copy().reshape(parts * entries, size)
    for r in added.collect():  # parts x entries rows at most
        out[r["slot"]] = np.array([r[n] for n in names], np.int64) // r["n"]
    return out.reshape(books.shape)


def train(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    books = start(rows, width, parts, entries)
    for _ in range(rounds):
        books = improved(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (bytes, an index a part) and error (the parts' squared distances together)."""
    parts, _, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Codebook(b) for b in books]
        for batch in batches:
            v = integers(batch.column("vector"), parts * size)
            found = [book.nearest(v[:, p * size : (p + 1) * size])[:2] for p, book in enumerate(held)]
            code = np.stack([i for i, _ in found], 1).astype(np.uint8)
            error = np.sum([d for _, d in found], 0) if len(v) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, label {kind}, code binary, error long")


def digest(books: np.ndarray) -> str:
    """Of all entries' components in decimal, by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(spark: SparkSession, coded: DataFrame, hot_parts: int = HOT_PARTS) -> DataFrame:
    """Adds label_error, the error of all rows of the label. Frequent labels meet their rows by broadcast, the others by a shuffle."""
    key = F.when(F.col("label").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("label").cast("string")))
    held = Table(spark, coded.withColumn("_key", key)).df
    sums = Table(spark, held.groupBy("_key").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n"))).df
    hot = sums.where(F.col("_n") > held.count() / hot_parts).drop("_n")  # hot_parts rows at most
    cold = held.join(F.broadcast(hot.select("_key")), "_key", "left_anti").join(sums.drop("_n"), "_key")
    return held.join(F.broadcast(hot), "_key").unionByName(cold).drop("_key")


def compress(spark: SparkSession, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, **names: str) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error, label_error of every usable vector; and the codebooks (parts x entries x part width)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte a part")
    rows, width = kept(vectors, parts, **names)
    books = train(rows, width, parts, entries, rounds) if width else np.zeros((parts, 0, 0), np.int64)
    if not width:
        kind = rows.schema["label"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id long, label {kind}, code binary, error long, label_error long"), books
    return with_label_error(spark, encode(rows, books)), books


def decoded(code: bytes, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in the vectors' own scale."""
    return np.concatenate([books[p, i] for p, i in enumerate(code)]) / SCALE


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = compress(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The query in SQL: exact distances of every part to every entry, in whole numbers."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (SELECT v.k, v.part, b.entry, CAST(sum((v.x - b.x) * (v.x - b.x)) AS BIGINT) AS d FROM v JOIN b{r} AS b ON b.part = v.part AND b.pos = v.pos GROUP BY v.k, v.part, b.entry),
a{r} AS MATERIALIZED (SELECT k, part, least.entry AS entry, least.d AS d FROM (SELECT k, part, min({{'d': d, 'entry': entry}}) AS least FROM d{r} GROUP BY k, part))""")
        if r < rounds:
            steps.append(f"""u{r} AS (SELECT a.part, a.entry, v.pos, CAST(sum(v.x) AS BIGINT) AS s, count(*) AS n FROM a{r} AS a JOIN v USING (k, part) GROUP BY a.part, a.entry, v.pos),
b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, CASE WHEN u.n IS NULL THEN b.x ELSE (u.s - ((u.s % u.n) + u.n) % u.n) // u.n END AS x FROM b{r} AS b LEFT JOIN u{r} AS u USING (part, entry, pos))""")
    chain = ",\n".join(steps)
    return f"""
WITH rows_ AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS k, vec_id, label, embedding AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT k, CAST(floor(256.0::DOUBLE * unnest(e)) AS BIGINT) AS x, unnest(range(len(e))) AS i, len(e) // {parts} AS size FROM rows_),
v AS MATERIALIZED (SELECT k, i // size AS part, i % size AS pos, x FROM c),
b0 AS (SELECT part, k - 1 AS entry, pos, x FROM v WHERE k <= {entries}),
{chain},
coded AS (SELECT k, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY k),
book AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM rows_ JOIN coded USING (k), book
"""
