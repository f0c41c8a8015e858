"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (native).

The ring has ``2**RING_BITS`` places. Every shard owns ``replicas`` virtual nodes; a row goes
clockwise from the place of its key to the next virtual node. A shard takes rows up to its
bound; the rest of the arc continues clockwise to the next node with room. With ``slack`` 0
the bounds add up to the number of rows, so every shard is filled to its bound and counts
differ by one at most (law ``rows``).

Rows meet the ring only as counts: one count per arc comes to the driver (``shards * replicas``
of them at most, whatever the input), which decides how the arcs flow. An arc is cut into cells
by a hash of the key and the kept columns, about ``cell_rows`` rows each; a row's rank in its arc is the number
of rows in earlier cells plus its number within the cell, so no window is larger than a cell, also if one key holds
most rows. Equal rows are counted before their shuffle and ranked as one; they are dealt out again in runs of
``cell_rows``.

Cases: null doc_id hashes like any value; null text has size 16 and crc32 0; repeated rows each get
a slot of their own; ties (equal rows) are interchangeable; very long texts count as their bytes; an empty table gives no rows;
extra columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RING_BITS = 16


def ring_nodes(shards: int, replicas: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, in ring order; the lower shard keeps a contested place."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for r in range(replicas):
            place = xxhash.xxh64_intdigest(f"{shard}/{r}", 7) >> (64 - RING_BITS)
            taken.setdefault(place, shard)
    for shard in set(range(shards)) - set(taken.values()):  # so many shards that one lost all places
        taken[next(p for p in range(1 << RING_BITS) if p not in taken)] = shard
    return sorted(taken.items())


def bounds(total: int, shards: int, slack: float) -> list[int]:
    """The most rows each shard takes; together at least ``total``."""
    if slack > 0:
        return [math.ceil((1 + slack) * total / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def flow(counts: dict[int, int], nodes: list[tuple[int, int]], limit: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): where the rows of each arc go.

    In rounds: every arc offers its rows at its node; what a full shard refuses is
    offered at the next node clockwise in the next round.
    """
    used, out = [0] * len(limit), []
    waiting = {a: (0, n) for a, n in counts.items() if n}
    step = 0
    while waiting:
        left = {}
        for arc in sorted(waiting):
            lo, hi = waiting[arc]
            shard = nodes[(arc + step) % len(nodes)][1]
            take = min(hi - lo, limit[shard] - used[shard])
            if take:
                out.append((arc, lo, lo + take, shard, used[shard]))
                used[shard] += take
            if lo + take < hi:
                left[arc] = (lo + take, hi)
        waiting, step = left, step + 1
    return out


def looked_up(values: np.ndarray, at: F.Column) -> F.Column:
    """The value at a place of a fixed table of whole numbers under 2**32: four bytes each of one binary constant."""
    four = F.substring(F.lit(values.astype(">u4").tobytes()), at * 4 + 1, F.lit(4))
    return F.conv(F.hex(four), 16, 10).cast("int")


def shard(spark: SparkSession, docs: DataFrame, shards: int = 40, replicas: int = 64, slack: float = 0.0, cell_rows: int = 20_000, key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """The key, the kept columns, and shard int, slot long (gapless from 0 in each shard)."""
    nodes = ring_nodes(shards, replicas)
    places = [p for p, _ in nodes]
    arc_of = np.searchsorted(places, np.arange(1 << RING_BITS)) % len(nodes)
    names = ["_key", *[f"_keep_{i}" for i in range(len(keep))]]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip((key, *keep), names, strict=True)])
    place = F.shiftrightunsigned(F.xxhash64("_key"), 64 - RING_BITS).cast("int")
    rows = rows.withColumn("_arc", looked_up(arc_of, place))
    counts = {r[0]: r[1] for r in rows.groupBy("_arc").count().collect()}  # an arc a row, shards * replicas at most
    by_arc: dict[int, list] = defaultdict(list)
    for arc, lo, hi, s, at in flow(counts, nodes, bounds(sum(counts.values()), shards, slack)):
        by_arc[arc].append((lo, hi, s, at))
    arcs = F.broadcast(spark.createDataFrame(sorted(by_arc.items()), "_arc int, _spans array<struct<lo:long,hi:long,shard:int,at:long>>"))
    cells_of = np.array([max(1, -(-counts.get(arc, 0) // cell_rows)) for arc in range(len(nodes))])
    many_cells = cells_of.max() > 1
    rows = rows.withColumn("_h", F.xxhash64(F.lit(1), *names)).withColumn("_cell", F.pmod("_h", looked_up(cells_of, F.col("_arc"))).cast("int") if many_cells else F.lit(0))
    equal = rows.groupBy("_arc", "_cell", "_h", *names).agg(F.count("*").alias("_copies"))
    within = Window.partitionBy("_arc", "_cell").orderBy("_h", *names).rowsBetween(Window.unboundedPreceding, -1)
    ranked = equal.withColumn("_first", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
    if many_cells:  # the rows in an arc's earlier cells
        before = Window.partitionBy("_arc").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = rows.groupBy("_arc", "_cell").count().select("_arc", "_cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
        ranked = ranked.join(cells, ["_arc", "_cell"]).withColumn("_first", F.col("_before") + F.col("_first"))
    # A run of copies after the other; a long row of runs is dealt out before each run becomes rows.
    run = F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(cell_rows).cast("long"))
    one = ranked.where("_copies = 1").select("_arc", *names, F.col("_first").alias("_rank"))
    runs = ranked.where("_copies > 1").select("_arc", *names, "_first", "_copies", F.explode(run).alias("_from")).repartition(F.xxhash64("_first", "_from"))
    many = runs.select("_arc", *names, F.explode(F.sequence(F.col("_first") + F.col("_from"), F.col("_first") + F.least(F.col("_from") + cell_rows, F.col("_copies")) - 1)).alias("_rank"))
    rows = one.unionByName(many).join(arcs, "_arc")
    rows = rows.withColumn("_s", F.filter("_spans", lambda x: (x.lo <= F.col("_rank")) & (x.hi > F.col("_rank")))[0])
    own = [F.col(n).alias(c) for c, n in zip((key, *keep), names, strict=True)]
    return rows.select(*own, F.col("_s.shard").alias("shard"), (F.col("_s.at") + F.col("_rank") - F.col("_s.lo")).alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = shard(spark, sized, keep=("size", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
