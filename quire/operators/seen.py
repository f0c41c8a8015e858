"""Hashes seen in earlier runs: a table in a shared folder, one folder a run, with a Bloom filter before the join.

A run's hashes become visible together, when Spark's committer has written the folder's ``_SUCCESS``; a run that fails before leaves
nothing that is read, and the same run done again takes its own folder over. Reading ``before`` a run gives what was there when it
began, so a run that is replayed decides as it did the first time.

The filter has ``2**FILTER_BITS`` bits and two hashes; it is a small table (slot, bits) a run, and their union is broadcast, bounded whatever the
number of hashes. Rows whose bits are not both set are new and skip the join; the rest meet the table, of which only the hashes
they ask for are kept first. With more hashes than the filter is good for more rows join; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Table, children, exists

#: Broadcast: 2**(FILTER_BITS - 6) rows of two longs at most, 16 MB.
FILTER_BITS = 26


def _bits(hash_: F.Column) -> list[tuple[F.Column, F.Column]]:
    """The (slot, bit) pairs of a hash."""
    out = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), hash_)
        out.append((F.shiftrightunsigned(h, 64 - FILTER_BITS + 6), F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))))
    return out


class SeenHashes:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def runs(self, before: int | None = None) -> list[int]:
        """The runs that have been committed, those from ``before`` on left out."""
        found = [int(n.split("=")[1]) for n in children(self.spark, self.path) if n.startswith("run=")]
        return sorted(n for n in found if (before is None or n < before) and exists(self.spark, f"{self.path}/run={n}/_SUCCESS"))

    def _read(self, kind: str, runs: list[int], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}={n}" for n in runs])

    def hashes(self, before: int | None = None) -> DataFrame:
        runs = self.runs(before)
        return self._read("run", runs, "hash string") if runs else self.spark.createDataFrame([], "hash string")

    def unseen(self, rows: DataFrame, column: str, before: int | None = None) -> DataFrame:
        """The rows whose hash no run before has; rows without a hash all stay."""
        runs = self.runs(before)
        if not runs:
            return rows
        bitmap = F.broadcast(self._read("filter", runs, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")))
        asked, maybe = rows, F.lit(True)
        for i, (slot, bit) in enumerate(_bits(F.col(column))):
            asked = asked.join(bitmap.select(F.col("slot").alias(f"_slot_{i}"), F.col("bits").alias(f"_bits_{i}")), slot == F.col(f"_slot_{i}"), "left")
            maybe = maybe & (F.coalesce(F.col(f"_bits_{i}"), F.lit(0).cast("long")).bitwiseAND(bit) != 0)
        held = Table(self.spark, asked.withColumn("_maybe", maybe & F.col(column).isNotNull()).select(*rows.columns, "_maybe")).df
        new, doubtful = held.where(~F.col("_maybe")).drop("_maybe"), held.where("_maybe").drop("_maybe")
        wanted = doubtful.select(F.col(column).alias("hash")).distinct()
        found = self._read("run", runs, "hash string").join(wanted, "hash", "left_semi").distinct()
        return new.unionByName(doubtful.join(found, doubtful[column] == found["hash"], "left_anti"))

    def commit(self, rows: DataFrame, column: str, run: int) -> None:
        """Adds the hashes of a run. Its filter comes first: without the hashes it is not read."""
        mine = Table(self.spark, rows.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("hash")).distinct())
        pairs = F.explode(F.array(*[F.struct(slot.alias("slot"), bit.alias("bits")) for slot, bit in _bits(F.col("hash"))]))
        filter_ = mine.df.select(pairs.alias("p")).select("p.*").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
        filter_.write.mode("overwrite").parquet(f"{self.path}/filter={run}")
        mine.df.write.mode("overwrite").parquet(f"{self.path}/run={run}")
        mine.drop()
