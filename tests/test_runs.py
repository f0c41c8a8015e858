"""What outlives a call, a task, a micro-batch or a run: concurrent calls, the ledger, hashes seen, and streams that begin again."""

import itertools
import os
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quire.operators import assemble, ledger, ocr, seen
from quire.sources import files
from quire.streaming import files as streams
from quire.streaming import first_seen

from test_documents import RICH, pdf, stream
from test_sources import W, packed

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this file


def batches(spark, n, parts=1):
    rows = spark.createDataFrame([(i // 5, i % 5, [f"i{i}"], f"text {i}") for i in range(n)], "doc_id long, batch_no int, ids array<string>, prompt string").coalesce(parts)
    return rows.withColumn("parts", F.array(F.struct(F.lit("text").alias("type"), F.col("prompt").alias("text")))).drop("prompt")


class Slow:
    """Takes a while, notes when each call began and ended, and fails on one in seven."""

    def __init__(self, notes):
        self.notes = notes

    def invoke(self, parts):
        i, began = int(parts[0]["text"].split()[1]), time.time()
        time.sleep(0.05 if i % 3 else 0.2)  # later calls end first
        with open(f"{self.notes}/{i}-{time.time_ns()}", "w") as f:
            f.write(f"{began} {time.time()}")
        if i % 7 == 3:
            raise ValueError(f"no {i}")
        return f"reply {i}", i, 1


def spans(notes):
    return [tuple(map(float, open(f"{notes}/{n}").read().split())) for n in sorted(os.listdir(notes))]


def most_at_once(found):
    return max(sum(a <= t < b for a, b in found) for t, _ in found)


def test_concurrent_calls(spark, tmp_path):
    """Calls overlap, but no more than allowed; rows keep their order; one failure stays alone; the result is that of serial calls."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 8)  # several frames a task
    try:
        got = {}
        for n in (1, 4):
            notes = tmp_path / str(n)
            notes.mkdir()
            out = ocr.call(batches(spark, 30), lambda notes=str(notes): Slow(notes), wait=0, in_flight=n)
            got[n] = [tuple(r[c] for c in ("doc_id", "batch_no", "ids", "reply", "error", "token_input", "token_output")) for r in out.collect()]
            assert most_at_once(spans(str(notes))) == n
            assert [r["elapsed_time"] > 0.04 for r in out.limit(1).collect()] == [True]
        assert got[1] == got[4] and [r[2] for r in got[4]] == [[f"i{i}"] for i in range(30)]
        assert [r[4] for r in got[4]] == [f"no {i}" if i % 7 == 3 else None for i in range(30)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_in_order_takes_no_more_than_it_runs():
    taken = []

    def items():
        for i in range(20):
            taken.append(i)
            yield i

    out = ocr.in_order(items(), lambda i: i * i, 3)
    assert next(out) == 0 and len(taken) == 3
    assert [*out] == [i * i for i in range(1, 20)]
    first = ocr.in_order(itertools.count(), lambda i: i, 2)
    assert next(first) == 0
    first.close()  # an endless source is left alone

    def bad(i):
        if i == 2:
            raise KeyError(i)
        return i

    with pytest.raises(KeyError):
        list(ocr.in_order(range(5), bad, 2))


def test_clients_of_threads(spark):
    class Own:
        def invoke(self, parts):
            time.sleep(0.02)
            return str(id(self)), 0, 0

    shared = {r["reply"] for r in ocr.call(batches(spark, 12), Own, in_flight=3).collect()}
    own = {r["reply"] for r in ocr.call(batches(spark, 12), Own, in_flight=3, shared=False).collect()}
    assert len(shared) == 1 < len(own) <= 3


class Mortal:
    """Its worker dies in the middle of the work, once."""

    def __init__(self, notes, death):
        self.notes, self.death = notes, death

    def invoke(self, parts):
        i = int(parts[0]["text"].split()[1])
        if i == 12 and not os.path.exists(self.death):
            open(self.death, "w").close()
            os._exit(1)
        open(f"{self.notes}/{i}-{time.time_ns()}", "w").close()
        if i == 5:
            raise ValueError("never")
        return f"reply {i}", 2, 3


def test_ledger_survives_a_lost_task(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    books = ledger.Ledger(spark, f"file://{tmp_path}/ledger")
    make = lambda: Mortal(str(notes), str(tmp_path / "death"))
    asked = batches(spark, 20)
    with pytest.raises(Exception):  # noqa: B017, PT011  a local session does not run a task again; the run is lost
        books.call(asked, make, wait=0).collect()
    done = {int(n.split("-")[0]) for n in os.listdir(notes)} - {5}
    assert 0 < len(done) < 20 and {r["reply"] for r in books.known().collect()} == {f"reply {i}" for i in done}
    rows = books.call(asked, make, wait=0).collect()
    assert {r["ids"][0]: (r["reply"], r["error"], r["token_input"]) for r in rows} == {f"i{i}": (None, "never", 0) if i == 5 else (f"reply {i}", None, 2) for i in range(20)}
    assert {r["ids"][0] for r in rows if r["cached"]} == {f"i{i}" for i in done}
    times = [int(n.split("-")[0]) for n in os.listdir(notes)]
    assert all(times.count(i) == 1 for i in range(20) if i != 5) and times.count(5) >= 1
    books.compact()
    assert not os.path.exists(f"{tmp_path}/ledger/open") and books.known().count() == 19
    before = len(os.listdir(notes))
    again = books.call(asked.unionByName(asked.withColumn("doc_id", F.col("doc_id") + 100)), make, wait=0).collect()
    assert len(again) == 40 and sum(r["cached"] for r in again) == 38 and len(os.listdir(notes)) == before + 1  # the failed call, asked for twice, is made once
    other = books.call(asked.limit(1), make, settings="another model", wait=0).collect()
    assert [r["cached"] for r in other] == [False]
    books.compact()
    os.rename(f"{tmp_path}/ledger/done", f"{tmp_path}/ledger/done-of-old")  # another ledger begins empty
    assert books.known().count() == 0


def test_recorder_answers_a_task_run_again(tmp_path):
    remember = ledger.recorder(f"file://{tmp_path}")()
    assert remember("k", lambda: ("r", None, 0.5, 1, 2)) == ("r", None, 0.5, 1, 2)
    assert remember("k", lambda: 1 / 0) == ("r", None, 0.5, 1, 2)
    assert remember("e", lambda: (None, "down", 0.1, 0, 0))[1] == "down" and remember("e", lambda: ("up", None, 0.1, 0, 0))[0] == "up"
    assert sorted(os.listdir(tmp_path)) == ["e.json", "k.json"]


def test_seen_hashes(spark, tmp_path):
    """Three runs in a row equal one; a failed run leaves no trace; a run that is done again decides as before."""
    rows = spark.createDataFrame([(i, f"h{i * i % 97}" if i % 10 else None) for i in range(300)], "i long, h string")
    table = seen.SeenHashes(spark, f"file://{tmp_path}/seen")
    kept = []
    for run in range(3):
        mine = assemble.first_seen(rows.where(f"i div 100 = {run}"), "h", ("i",))
        if run == 1:
            broken = mine.withColumn("h", F.when(F.col("i") == 150, F.raise_error(F.lit("lost"))).otherwise(F.col("h")))
            with pytest.raises(Exception, match="lost"):
                table.commit(broken, "h", run)
            bad = tmp_path / "seen" / "run=1"  # as if the folder had been begun
            bad.mkdir()
            (bad / "part-0.parquet").write_bytes(b"half")
            assert table.runs() == [0]
        new = table.unseen(mine, "h")
        kept += [r["i"] for r in new.collect()]
        table.commit(mine, "h", run)
        assert sorted(r["i"] for r in table.unseen(mine, "h", before=run).collect()) == sorted(r["i"] for r in mine.collect() if r["i"] in kept)
        table.commit(mine, "h", run)  # done again
    assert sorted(kept) == sorted(r["i"] for r in assemble.first_seen(rows, "h", ("i",)).collect())
    assert table.runs() == [0, 1, 2] and table.hashes().distinct().count() == rows.select("h").distinct().count() - 1
    plan = table.unseen(rows, "h")._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and table.unseen(rows, "h").where("h is not null").count() == 0


def test_filter_only_saves_work(spark, tmp_path, monkeypatch):
    """With a filter of so few bits that it says yes to nearly all, the result is the same."""
    monkeypatch.setattr(seen, "FILTER_BITS", 7)
    table = seen.SeenHashes(spark, f"file://{tmp_path}/seen")
    rows = spark.range(2000).select(F.col("id").cast("string").alias("h"))
    table.commit(rows.where("cast(h as long) % 3 = 0"), "h", 0)
    assert table.unseen(rows, "h").count() == 2000 - 667


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", first_seen.ROCKSDB)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_first_seen_stream(spark, rocks, tmp_path):
    """The first by order whatever the order of arrival; no state is left once all keys are out."""
    rows = [(f"k{i % 7}", (i * 37) % 101, i) for i in range(60)]
    want = sorted((k, min(o for kk, o, _ in rows if kk == k)) for k in {k for k, _, _ in rows})
    for turn, order in enumerate((rows, rows[::-1], rows[::2] + rows[1::2])):
        src = tmp_path / f"in{turn}"
        for n in range(6):
            part = spark.createDataFrame([(k, o, 1000 + s) for k, o, s in order[n * 10 : n * 10 + 10]], "k string, o long, s long")
            part.withColumn("at", F.timestamp_seconds("s")).coalesce(1).write.mode("append").parquet(str(src))
            time.sleep(0.02)
        schema = spark.read.parquet(str(src)).schema
        # One more row, far later, moves the watermark past all the others.
        spark.createDataFrame([("end", 0, 9000)], "k string, o long, s long").withColumn("at", F.timestamp_seconds("s")).coalesce(1).write.mode("append").parquet(str(src))
        s = streams.stream(spark, str(src), schema, max_files=2)
        out = first_seen.first_seen(s, "k", ("o",), "at", 60_000, late="100 seconds")
        q = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"c{turn}")).option("path", str(tmp_path / f"out{turn}")).trigger(availableNow=True).start()
        q.awaitTermination()
        got = sorted((r["k"], r["o"]) for r in spark.read.parquet(str(tmp_path / f"out{turn}")).collect())
        assert got == want
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4  # of the last key alone: the value, the timer and its index


class Reader:
    """Answers each image with a count of the calls so far, so that a repeated call would show."""

    def __init__(self, notes):
        self.notes = notes

    def invoke(self, parts):
        ids = [p["text"][5:-2] for p in parts if p["type"] == "text" and p["text"].startswith("[ID: ")]
        name = f"{self.notes}/{'-'.join(i[:8] for i in ids)}"
        with open(name, "a") as f:
            f.write("x")
        return "".join(f"<{i}>read {len(open(name).read())}</{i}>" for i in ids), 1, 1


def picture(shift):
    px = RICH.copy()
    px[:, : 8 * shift + 8] = 255 - px[:, : 8 * shift + 8]
    return stream(b"/Type /XObject /Subtype /Image /Width 64 /Height 64 /ColorSpace /DeviceRGB /BitsPerComponent 8 ", px.tobytes(), True)


def one_page(text, *images):
    named = b" ".join(b"/Im%d %d 0 R" % (i, 5 + i) for i in range(len(images)))
    shown = b" ".join(b"q 64 0 0 64 10 %d cm /Im%d Do Q" % (300 - 10 * i, i) for i in range(len(images)))
    return pdf(b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>", b"<< /Type /Page /Parent 2 0 R /Contents 4 0 R /Resources << /XObject << " + named + b" >> >> >>",
               stream(b"", b"BT 10 700 Td (%s) Tj ET %s" % (text.encode(), shown)), *images)


@pytest.mark.parametrize("stop_at", [None, 0, 1, 2])
def test_file_stream_restarts(spark, tmp_path, monkeypatch, stop_at):
    """A stream that is lost in any micro-batch, after the batch's calls, and begins again gives the same table, and pays for no call twice."""
    src, notes = tmp_path / "in", tmp_path / "notes"
    src.mkdir()
    notes.mkdir()
    names = [("a.pdf", one_page("first", picture(0), picture(1))), ("b.pdf", one_page("second", picture(1), picture(2))), ("c.docx", packed({"word/document.xml": f"<w:document {W}><w:body/></w:document>"})), ("d.md", b"plain")]
    for i, (name, data) in enumerate(names):
        (src / name).write_bytes(data)
        os.utime(src / name, (1_700_000_000 + i, 1_700_000_000 + i))  # files are taken in this order
    options = ocr.Options(min_score=0.0)
    run = lambda: streams.documents(spark, f"file://{src}", f"file://{tmp_path}/out", f"file://{tmp_path}/state", options, lambda: Reader(str(notes)), max_files=1)
    if stop_at is not None:
        read = streams.document.read_files

        def lost(*args, **kw):
            out = read(*args, **kw)
            if kw["run"] == stop_at:
                out.collect()
                raise OSError("lost")
            return out

        monkeypatch.setattr(streams.document, "read_files", lost)
        with pytest.raises(Exception, match="lost"):
            run()
        monkeypatch.setattr(streams.document, "read_files", read)
    run()
    rows = {r["path"].rsplit("/", 1)[1]: r for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    assert len(rows) == 4 and {n: r["batch"] for n, r in rows.items()} == {"a.pdf": 0, "b.pdf": 1, "c.docx": 2, "d.md": 3}
    assert rows["a.pdf"]["text"] == "first\nread 1\nread 1\n"
    assert rows["b.pdf"]["text"] == "second\n\nread 1\n"  # its first image had been seen in another batch
    assert rows["c.docx"]["text"] == "" and rows["d.md"]["text"] == "plain" and {r["status"] for r in rows.values()} == {"ok"}
    assert all(len(open(f"{notes}/{n}").read()) == 1 for n in os.listdir(notes)) and len(os.listdir(notes)) == 2
    assert not [n for n in os.listdir(tmp_path / "state" / "calls") if n != "done"]
    run()  # nothing new
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 4


def test_text_blocks_do_not_meet(spark):
    """No task gets the text blocks of all documents for their missing image ids; pages come out as before."""
    lines = spark.range(0, 4000, 1, 8).select(F.col("id").alias("doc_id"), F.lit(0).alias("page_no"), F.lit(0).alias("block_no"), F.lit(None).cast("string").alias("image_id"), F.lit("x").alias("text"))
    images = spark.range(0, 40).select(F.col("id").alias("doc_id"), F.lit(0).alias("page_no"), F.lit(1).alias("block_no"), F.concat(F.lit("i"), F.col("id").cast("string")).alias("image_id"), F.lit("").alias("text"))
    found = spark.range(0, 20).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("image_id"), F.lit(" seen ").alias("content"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = assemble.with_replies(lines.unionByName(images), found)
        per_task = [r["n"] for r in joined.where("block_no = 0").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(per_task) <= 2 * 4000 / 8 and sum(per_task) == 4000
        assert {r["text"] for r in joined.where("block_no = 1").collect()} == {"seen\n", "\n"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_empty_files_are_files(spark):
    df = spark.createDataFrame([("x.docx", bytearray(packed({"word/document.xml": f"<w:document {W}><w:body/></w:document>"}))), ("y.pdf", bytearray(b"%PDF-1.4 1 0 obj << /Type /Catalog >> endobj"))], "path string, content binary")
    assert [(r["path"], r["page_no"], r["block_type"], r["status"]) for r in files.blocks(files.routed(df)).orderBy("path").collect()][0] == ("x.docx", 0, -1, "ok")
