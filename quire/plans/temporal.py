"""Queries over time (as-of and overlap joins, joined streams, sessions), over mergeable sketches, and by a model."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from ..operators import inference, sketches, temporal
from ..storage import Table, application_folder
from ..streaming import joins
from .queries import query, read


@query("""
WITH p AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase'), c AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'click')
SELECT p.event_id, c.event_id AS click_id, c.value AS click_value FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts >= c.ts""")
def asof_join(spark, sf):
    """Each purchase with its user's last click."""
    e = read(spark, sf, "events").select("user_id", "ts", "event_id", "value", "event_type")
    clicks = e.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    out = temporal.asof(e.where("event_type = 'purchase'").drop("event_type"), clicks, {"user_id": "user_id"}, ("ts", "ts"), ("click_id", "click_value"), ("click_id",))
    return out.select("event_id", "click_id", "click_value")


@query("""
WITH o AS (SELECT o_custkey % 150 AS user_id, o_orderkey, o_orderdate + INTERVAL 26 YEAR AS since FROM orders),
l AS (SELECT user_id, since, max(o_orderkey) AS o_orderkey FROM o GROUP BY user_id, since)
SELECT event_id, o_orderkey FROM events e ASOF LEFT JOIN l ON e.user_id = l.user_id AND e.ts >= l.since""")
def asof_orders(spark, sf):
    """Each event with its customer's last order, by order number where a day has several."""
    o = read(spark, sf, "orders").select((F.col("o_custkey") % 150).alias("cust"), "o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL '26' YEAR")).alias("at"))
    e = read(spark, sf, "events").select("user_id", "ts", "event_id")
    return temporal.asof(e, o, {"user_id": "cust"}, ("ts", "at"), ("o_orderkey",), ("o_orderkey",)).select("event_id", "o_orderkey")


SPAN_SQL = "SELECT event_id, user_id, event_type, epoch_us(ts) AS lo, epoch_us(ts) + (1 + (event_id * 7919) % 100 * (event_id % 13) * (event_id % 13)) * 60000000 AS hi FROM events"


@query(f"""
WITH s AS ({SPAN_SQL})
SELECT a.event_id AS click, b.event_id AS error FROM s a JOIN s b ON a.user_id = b.user_id AND a.lo < b.hi AND b.lo < a.hi WHERE a.event_type = 'click' AND b.event_type = 'error'""")
def overlap_join(spark, sf):
    """Clicks and errors of a user whose spans, of a minute to ten days, overlap."""
    hi = F.expr("unix_micros(cast(ts as timestamp)) + (1 + (event_id * 7919) % 100 * (event_id % 13) * (event_id % 13)) * 60000000")
    s = read(spark, sf, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("lo"), hi.alias("hi"))
    side = lambda kind, n: s.where(F.col("event_type") == kind).select(F.col("event_id").alias(kind), F.col("user_id").alias(f"user_{n}"), F.col("lo").alias(f"lo_{n}"), F.col("hi").alias(f"hi_{n}"))
    return temporal.overlaps(side("click", 1), side("error", 2), ("lo_1", "hi_1"), ("lo_2", "hi_2"), {"user_1": "user_2"}).select("click", "error")


def _timed_files(spark, sf, at: str, last: str | None = None) -> None:
    """The events in files by time; a row much later than all others comes last."""
    e = read(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    e.repartitionByRange(6, "ts").write.parquet(f"{at}/in/part=1")
    if last:
        e.limit(1).withColumns({"user_id": F.lit(-1).cast("long"), "event_type": F.lit("end"), "ts": F.lit(last).cast("timestamp").cast(e.schema["ts"].dataType)}).write.parquet(f"{at}/in/part=2")


def _run(out, at: str) -> None:
    out.writeStream.format("parquet").option("checkpointLocation", f"{at}/state").option("path", f"{at}/out").trigger(availableNow=True).start().awaitTermination()


@query("""
SELECT c.event_id AS click, p.event_id AS purchase FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts BETWEEN c.ts - INTERVAL 30 MINUTE AND c.ts + INTERVAL 2 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def stream_join(spark, sf):
    """Clicks and purchases of a user near one another, of two streams."""
    at = f"{application_folder(spark)}/join-{uuid.uuid4().hex}"
    _timed_files(spark, sf, at)
    schema = spark.read.parquet(f"{at}/in").drop("part").schema
    side = lambda kind: spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(f"{at}/in/part=1").where(F.col("event_type") == kind).select(F.col("event_id").alias(kind), F.col("user_id").alias(f"{kind}_user"), F.col("ts").cast("timestamp").alias(f"{kind}_ts"))
    out = joins.within(side("click"), side("purchase"), {"click_user": "purchase_user"}, ("click_ts", "purchase_ts"), "30 MINUTES", "2 HOURS", ("60 days", "60 days")).select("click", "purchase")
    _run(out, at)
    return spark.read.schema(out.schema).parquet(f"{at}/out")


@query("""
WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 3 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 3 HOUR AS session_end, count(*) AS n, max(value) AS most FROM s GROUP BY user_id, k""")
def stream_sessions(spark, sf):
    """Sessions of users whose events lie under three hours apart, from a stream."""
    at = f"{application_folder(spark)}/sessions-{uuid.uuid4().hex}"
    _timed_files(spark, sf, at, "2030-01-01 00:00:00")
    schema = spark.read.parquet(f"{at}/in").drop("part").schema
    rows = spark.readStream.schema(schema.add("part", IntegerType())).option("maxFilesPerTrigger", 3).parquet(f"{at}/in").drop("part").withColumn("ts", F.col("ts").cast("timestamp"))
    out = joins.sessions(rows, ("user_id",), "ts", "3 hours", "60 days", F.count("*").alias("n"), F.max("value").alias("most"))
    _run(out, at)
    kind = read(spark, sf, "events").schema["ts"].dataType
    done = spark.read.schema(out.schema).parquet(f"{at}/out").where("user_id >= 0")
    return done.select("user_id", F.col("session_start").cast(kind).alias("session_start"), F.col("session_end").cast(kind).alias("session_end"), "n", "most")


@query("""
WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, event_id, user_id, value FROM events)
SELECT event_type, CAST(date_trunc('week', day) AS DATE) AS week, count(*) AS n, min(value) AS least, max(value) AS most, true AS distinct_near, true AS median_near
FROM c GROUP BY CUBE (event_type, CAST(date_trunc('week', day) AS DATE))""")
def sketch_cube(spark, sf):
    """Distinct users and median values by type and week, and over all of either, from a store by type and day; near the exact ones?"""
    e = read(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), "user_id", "value")
    stored = Table(spark, sketches.store(e, ("event_type", "day"), "user_id", "value")).df
    weekly = sketches.merged(stored.withColumn("week", F.to_date(F.date_trunc("week", "day"))), ("event_type", "week"), cube=True)
    found = sketches.answers(weekly)
    # The rows themselves, in each cell they belong to, beside its answers.
    cells = F.array(*[F.struct(F.when(F.lit(i), F.col("event_type")).alias("event_type"), F.when(F.lit(j), F.to_date(F.date_trunc("week", "day"))).alias("week")) for i in (True, False) for j in (True, False)])
    rows = e.select("user_id", "value", F.explode(cells).alias("c")).select("user_id", "value", F.col("c.event_type").alias("kind"), F.col("c.week").alias("monday"))
    both = rows.join(F.broadcast(found), F.col("event_type").eqNullSafe(F.col("kind")) & F.col("week").eqNullSafe(F.col("monday")))  # cells, not rows, on the right
    share = lambda test: F.avg(F.when(test, 1.0).otherwise(0.0))
    below, up_to = share(F.col("value") < F.col("q50")), share(F.col("value") <= F.col("q50"))
    near = F.abs(F.first("distinct") - F.countDistinct("user_id")) <= F.greatest(F.lit(1), F.ceil(sketches.DISTINCT_ERROR * F.countDistinct("user_id")))
    median = (below <= 0.5 + sketches.RANK_ERROR) & (up_to >= 0.5 - sketches.RANK_ERROR)
    return both.groupBy("event_type", "week", "n", "least", "most").agg(near.alias("distinct_near"), median.alias("median_near"))


#: Weights of a small network: whole numbers, so that SQL gives the same sums.
HIDDEN, WIDTH = 4, 64


def _network():
    """Loaded in the worker: a layer of HIDDEN units with rectification, and their sum."""
    import numpy as np

    weights = np.array([[(i * 7 + j * 13) % 9 - 4 for j in range(HIDDEN)] for i in range(WIDTH)], np.float64)

    def predict(rows):
        return np.maximum(np.floor(rows.astype(np.float64) * 256) @ weights, 0).sum(1)

    return predict


@query(f"""
WITH x AS (SELECT vec_id, floor(CAST(unnest(embedding) AS DOUBLE) * 256) AS x, unnest(range(len(embedding))) AS i FROM embeddings),
h AS (SELECT vec_id, j, greatest(sum(x * ((i * 7 + j * 13) % 9 - 4)), 0) AS h FROM x, range({HIDDEN}) AS r(j) GROUP BY vec_id, j)
SELECT vec_id, sum(h) AS score FROM h GROUP BY vec_id""")
def model_scores(spark, sf):
    """A network over the embeddings, asked by the batch."""
    score = inference.scores(_network, WIDTH, DoubleType(), 128)
    return read(spark, sf, "embeddings").select("vec_id", score("embedding").alias("score"))
