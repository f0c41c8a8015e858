"""Frames in tasks stay small whatever Spark's batches hold."""

import pyarrow as pa
from pyspark.sql import functions as F

from quire import frames
from quire.operators import document, ocr, raster
from quire.sources import files


def test_small_frames_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"i": [None, *range(2**53 + 1, 2**53 + 1000)], "s": [[{"a": 1, "b": None}]] * 1000, "b": [b"x" * 1000] * 1000})
    for rows, size, most in ((256, 1 << 30, 256), (256, 50_000, 50), (1, 1 << 30, 1), (5000, 1, 1)):
        got = list(frames.small([batch, batch.slice(0, 0)], rows, size))
        assert max(map(len, got)) <= most and [i for f in got for i in f["i"]] == batch.column("i").to_pylist()
    assert dict(got[0]["s"][0][0]) == {"a": 1, "b": None}


def test_a_task_sees_small_frames(spark):
    """A batch of 3,000 rows in one partition: no frame over the bound, values as they were."""

    def run(given):
        for f in given:
            yield f.assign(size=len(f))

    rows = spark.range(3000, numPartitions=1).select(F.when(F.col("id") % 7 > 0, F.col("id") + 2**53 + 1).alias("i"), F.array(F.struct(F.lit("x").alias("a"))).alias("s"), F.lit(b"\x00\xff").alias("b"))
    out = frames.map_frames(rows, run, "i long, s array<struct<a:string>>, b binary, size int")
    assert out.agg(F.max("size")).first()[0] <= frames.ROWS
    assert sorted(map(str, out.drop("size").collect())) == sorted(map(str, rows.collect()))


def test_readers_scores_and_calls_take_small_frames(spark):
    content = files.routed(spark.createDataFrame([("a.txt", b"x")], "path string, content binary"))
    images = spark.createDataFrame([("i", b"x")], "image_id string, bytes binary")
    batches = spark.createDataFrame([], "doc_id string, batch_no int, images array<struct<place:int,image_id:string,bytes:binary>>")
    asked = spark.createDataFrame([], "doc_id string, batch_no int, ids array<string>, parts array<struct<type:string,text:string>>")
    for df in (files.parts(content), files.blocks(content), raster.score(images, bytes), document.encoded(batches), ocr.call(asked, object)):
        assert "MapInPandas" not in df._jdf.queryExecution().toString()
