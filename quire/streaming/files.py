"""The same operators over streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import document, ocr
from ..operators.ledger import Ledger
from ..operators.seen import SeenHashes
from ..sources import files as S


def stream(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def dedup(rows: DataFrame, key: str, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """First of each key. Without an event time the state is kept for good; with one it is bounded by the delay."""
    if event_time is None:
        return rows.dropDuplicates([key])
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def each_batch(rows: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Run a batch pipeline on every micro-batch; a batch's number names its folder, so a replay overwrites it."""
    return rows.writeStream.foreachBatch(lambda df, n: work(df).write.mode("overwrite").parquet(f"{out}/batch={n}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def documents(spark: SparkSession, source: str, out: str, state: str, options: ocr.Options | None = None, make: Callable | None = None, settings: str = "", max_files: int = 1000, **options_of_reading):
    """New files of a folder to text, by the whole document path: ``out`` has a folder a micro-batch, with the rows of ``read_files``.

    ``state`` keeps what outlives a run: the stream's own checkpoint, the ledger of calls, and the hashes of images seen. A micro-batch that is
    done again, because the run was lost in it, overwrites its folder, takes its calls from the ledger, and looks only at hashes of the
    batches before it; so a restart at any point gives the same table. Waits until all files that are there are read.
    """
    ledger, seen = Ledger(spark, f"{state}/calls"), SeenHashes(spark, f"{state}/images")

    def work(batch: DataFrame, n: int) -> None:
        rows = document.read_files(spark, S.routed(batch), options, make, ledger=ledger, seen=seen, run=n, settings=settings, **options_of_reading)
        rows.write.mode("overwrite").parquet(f"{out}/batch={n}")

    rows = spark.readStream.format("binaryFile").schema(S.FILES).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").load(source)
    query = rows.writeStream.foreachBatch(work).option("checkpointLocation", f"{state}/stream").trigger(availableNow=True).start()
    query.awaitTermination()
    ledger.compact()
