"""Queries over what outlives a run: concurrent calls, the ledger, hashes seen, streams that keep an order and streams of files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import assemble as A
from ..operators import ledger, ocr, seen
from ..storage import Table, application_folder
from ..streaming import files, first_seen
from .queries import BATCH_SQL, SQL, TurnClient, _batches, query, read


def _folder(spark, name: str) -> str:
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _asked(spark, sf) -> DataFrame:
    rows = _batches(spark, sf).withColumnRenamed("conv_id", "doc_id")
    return rows.select("doc_id", "batch_no", F.transform("parts", lambda p: p["image_id"]).alias("ids"), A.prompt_parts(F.col("parts"), "Read.").alias("parts"))


@query(SQL["ocr_replies"])
def ocr_concurrent(spark, sf):
    """Four calls of a task open at once: the same replies as one after the other."""
    return ocr.parse(Table(spark, ocr.call(_asked(spark, sf), TurnClient, wait=0, in_flight=4)).df)


CALL_SQL = f"SELECT conv_id AS doc_id, batch_no, bool_or(length(text) % 11 = 0) AS failed, string_agg(text, chr(0) ORDER BY turn) AS said FROM ({BATCH_SQL}) GROUP BY conv_id, batch_no"


@query(f"SELECT doc_id, batch_no, CASE WHEN failed THEN '{T.API_ERROR % 'cannot read this'}' END AS error, doc_id % 3 <> 0 AND NOT failed AS cached FROM ({CALL_SQL})")
def ledger_calls(spark, sf):
    """All batches after a run over two thirds of them: what succeeded then is not called again, what failed is."""
    books, asked = ledger.Ledger(spark, _folder(spark, "ledger")), _asked(spark, sf)
    Table(spark, books.call(asked.where("doc_id % 3 = 1"), TurnClient, wait=0)).drop()
    books.compact()
    Table(spark, books.call(asked.where("doc_id % 3 = 2"), TurnClient, wait=0, in_flight=4)).drop()
    calls = Table(spark, books.call(asked, TurnClient, wait=0, in_flight=4)).df
    return calls.select("doc_id", "batch_no", F.when(F.col("error").isNotNull(), F.format_string(T.API_ERROR, F.col("error"))).alias("error"), "cached")


@query("""
WITH d AS (SELECT doc_id, (doc_id * 7 % 3)::INT AS run, md5(text) AS dhash FROM documents),
f AS (SELECT *, min(run) OVER (PARTITION BY dhash) AS first FROM d)
SELECT run, dhash, min(doc_id) AS doc_id FROM f WHERE run = first GROUP BY run, dhash""")
def seen_runs(spark, sf):
    """Three runs, each with what the ones before have not seen; their hashes stay in a table."""
    table = seen.SeenHashes(spark, _folder(spark, "seen"))
    rows = read(spark, sf, "documents").select(F.expr("cast(doc_id * 7 % 3 as int)").alias("run"), F.md5("text").alias("dhash"), "doc_id")
    out = None
    for run in range(3):
        first = Table(spark, A.first_seen(rows.where(F.col("run") == run), "dhash", ("doc_id",))).df
        new = Table(spark, table.unseen(first, "dhash", run)).df
        table.commit(first, "dhash", run)
        out = new if out is None else out.unionByName(new)
    return out


@query("SELECT md5(text) AS dhash, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def stream_first(spark, sf):
    """The first document of each text from a stream of files that come in another order."""
    at, n = _folder(spark, "first"), 6
    rows = read(spark, sf, "documents").select(F.md5("text").alias("dhash"), "doc_id", F.timestamp_seconds(1 + F.col("doc_id") % 1000).alias("at"))
    last = rows.limit(1).select(F.lit(None).cast("string").alias("dhash"), F.lit(None).cast("long").alias("doc_id"), F.timestamp_seconds(F.lit(100_000)).alias("at"))
    rows.repartition(n, F.xxhash64("doc_id")).write.parquet(f"{at}/in/part=1")
    last.withColumn("dhash", F.lit("")).write.parquet(f"{at}/in/part=2")  # moves the watermark past all others
    key, held = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(key, first_seen.ROCKSDB)
    try:
        s = spark.readStream.schema("dhash string, doc_id long, at timestamp, part int").option("maxFilesPerTrigger", 3).parquet(f"{at}/in").drop("part")
        out = first_seen.first_seen(s, "dhash", ("doc_id",), "at", 10_000_000, late="1000 seconds")
        out.writeStream.format("parquet").option("checkpointLocation", f"{at}/state").option("path", f"{at}/out").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, held)
    return spark.read.schema(out.schema).parquet(f"{at}/out").where("dhash <> ''").select("dhash", "doc_id")


@query("SELECT ('k=' || doc_id % 12) AS folder, 'text' AS kind, string_agg(md5(text), chr(10) ORDER BY doc_id) || chr(10) AS text, 'ok' AS status FROM documents GROUP BY doc_id % 12")
def file_stream(spark, sf):
    """Files made of the documents, read as a stream through the whole document path in micro-batches of five."""
    at = _folder(spark, "files")
    rows = read(spark, sf, "documents").select((F.col("doc_id") % 12).alias("k"), "doc_id", F.md5("text").alias("h"))
    rows.repartition(4, "k").sortWithinPartitions("k", "doc_id").select("k", "h").write.partitionBy("k").text(f"{at}/in")
    files.documents(spark, f"{at}/in", f"{at}/out", f"{at}/state", ocr.Options(), TurnClient, max_files=5)
    read_ = spark.read.schema("path string, part_no int, kind string, text string, status string").option("recursiveFileLookup", "true").parquet(f"{at}/out")
    return read_.select(F.regexp_extract("path", "/(k=[0-9]+)/", 1).alias("folder"), "kind", "text", "status")
