"""Quality by importance resampling.

Two generative models over hashed word n-grams (unigrams and bigrams in ``buckets`` buckets): one of the
target (documents labelled quality 1), one of all raw text. A document's log weight is the log ratio of the
two, summed over its n-grams. Gumbel noise, drawn from the hash of the doc_id and the seed, is
added to it, and the documents with the k largest sums are the sample: drawing without
replacement in proportion to the weights. k is ``keep_share`` of the documents: a sampling operator's limit.

Both models are counted over all their documents; a task sends one row a bucket, so a shuffle holds
buckets x tasks rows. The k-th largest key is found exactly by counting the leading bits of the keys, 16 bits a
round: 65,536 counts come to the driver at most, and no task holds the keys of all documents.

Cases: null and empty texts have no n-grams and weight 0; ties are broken by doc_id, then by nothing: equal
(key, doc_id) rows are kept together; without target labels all weights are 0; an empty table gives no rows;
extra columns are ignored; a label joins only if the labelled ids number ``broadcast_rows`` at most
by broadcast, else by shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Table, Words, rolling, utf8

BUCKETS, KEEP_SHARE, SEED = 10_000, 0.85, 11
_BASE = 0x9E3779B97F4A7C15


def ngrams(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each n-gram and the number of its document."""
    words = Words(texts)
    h = words.hashes()
    doc = np.repeat(np.arange(len(texts)), np.diff(words.first))
    two = words.within(2)[:-1] if len(h) else np.zeros(0, bool)
    pairs = rolling(h, 2, _BASE)[two] if len(h) > 1 else np.zeros(0, np.uint64)
    bucket = np.concatenate([h % np.uint64(buckets), (pairs ^ (pairs >> np.uint64(29))) % np.uint64(buckets)]).astype(np.int64)
    return bucket, np.concatenate([doc, doc[:-1][two] if len(h) else doc])


def _pieces(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about size bytes of text."""
    lengths, start, total = [len(x or b"") for x in batch.column("text").cast(pa.binary()).to_pylist()], 0, 0
    for i, n in enumerate(lengths):
        total += n
        if total >= size or i == len(lengths) - 1:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0


def models(docs: DataFrame, buckets: int) -> np.ndarray:
    """Log ratio of the target's to the raw model's probability, for each bucket; docs has text and target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in _pieces(whole):
                bucket, doc = ngrams(utf8(batch.column("text")), buckets)
                raw += np.bincount(bucket, minlength=buckets)
                good = np.array(batch.column("target").to_pylist(), bool)
                target += np.bincount(bucket[good[doc]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    rows = docs.select("text", "target").mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.ones(buckets), np.ones(buckets)
    for r in rows:
        raw[r[0]] += r[1]
        target[r[0]] += r[2]
    if target.sum() == buckets:
        return np.zeros(buckets)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _pieces(whole):
                bucket, doc = ngrams(utf8(batch.column("text")), len(ratio))
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.bincount(doc, minlength=n).astype(np.int64)), pa.array(np.bincount(doc, weights=ratio[bucket], minlength=n).astype(float))], names=["doc_id", "n_ngrams", "log_weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_ngrams long, log_weight double")


def sortable(x) -> F.Column:
    """A non-negative long in the order of the doubles near x: fixed point with 20 bits after the point."""
    return (F.greatest(F.least(x, F.lit(1e11)), F.lit(-1e11)) * float(1 << 20) + float(1 << 58)).cast("long")


def top(keyed: DataFrame, k: int, rank: str = "rank") -> DataFrame:
    """The rows with the k largest ranks (long >= 0); rows equal to the k-th are told apart by ``tie`` (long >= 0)."""
    found, left = [], k
    for column in (rank, "tie"):
        prefix = 0
        for shift in (48, 32, 16, 0):
            cut = keyed
            for name, value in found:
                cut = cut.where(F.col(name) == value)
            if shift < 48:
                cut = cut.where(F.shiftrightunsigned(column, shift + 16) == prefix)
            counts = cut.groupBy(F.shiftrightunsigned(column, shift).alias("p")).count().orderBy(F.desc("p")).collect()  # 65,536 at most
            for r in counts:
                if r["count"] >= left:
                    prefix = r["p"]
                    break
                left -= r["count"]
        found.append((column, prefix))
    (a, x), (b, y) = found
    return keyed.where((F.col(a) > x) | ((F.col(a) == x) & (F.col(b) >= y)))


def resample(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep_share: float = KEEP_SHARE, buckets: int = BUCKETS, seed: int = SEED, broadcast_rows: int = 1_000_000) -> DataFrame:
    """doc_id, n_ngrams, log_weight, key of the sampled documents."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id", F.lit(True).alias("target")).distinct()
    side = F.broadcast(good) if good.count() <= broadcast_rows else good
    ratio = models(docs.select("doc_id", "text").join(side, "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target")), buckets)
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) + F.lit(0.5)) / float(1 << 53)
    keyed = weigh(docs, ratio).withColumn("key", F.col("log_weight") - F.log(-F.log(u)))
    keyed = keyed.withColumn("rank", sortable(F.col("key"))).withColumn("tie", F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
    held = Table(spark, keyed)
    n = held.df.count()
    out = top(held.df, max(1, math.ceil(keep_share * n))) if n else held.df
    return out.select("doc_id", "n_ngrams", "log_weight", "key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
