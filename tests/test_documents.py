"""The document path on files made here: order, pages, images, options, failures; and the image code by hand."""

import sys
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import assemble, document, ocr, raster
from quire.sources import files, images, jpeg
from quire.streaming import files as streams

from test_sources import W, packed

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this file

RNG = np.random.default_rng(5)
RICH = RNG.integers(0, 255, (64, 64, 3)).astype(np.uint8)


def pdf(*objects):
    return b"%PDF-1.7\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i, o) for i, o in enumerate(objects, 1))


def stream(head, body, flate=False):
    return b"<< %s %s>>\nstream\n%s\nendstream" % (head, b"/Filter /FlateDecode " if flate else b"", zlib.compress(body) if flate else body)


TWO_PAGES = pdf(
    b"<< /Type /Catalog /Pages 2 0 R >>",
    b"<< /Type /Pages /Kids [4 0 R 3 0 R] /Count 2 >>",
    b"<< /Type /Page /Parent 2 0 R /Contents 6 0 R >>",
    b"<< /Type /Page /Parent 2 0 R /Contents [5 0 R] /Resources << /XObject << /Im1 7 0 R /Im2 8 0 R /Im3 9 0 R >> >> >>",
    stream(b"", b"BT 1 0 0 1 10 100 Tm (last) Tj ET q 64 0 0 64 10 300 cm /Im1 Do Q BT 10 700 Td [(fi) -10 (rst) -400 (line)] TJ 0 -12 Td (of \\(two\\)) Tj ET q 1 0 0 1 10 200 cm /Im2 Do Q /Im3 Do "
                b"BT /F1 12 Tf 50 650 Td (right) Tj ET BT 10 650 Td <FEFF00E9> Tj ET", True),  # fmt: skip
    stream(b"", b"BT 10 10 Td (page (nested) two) Tj ET"),
    stream(b"/Type /XObject /Subtype /Image /Width 64 /Height 64 /ColorSpace /DeviceRGB /BitsPerComponent 8 ", RICH.tobytes(), True),
    stream(b"/Type /XObject /Subtype /Image /Width 64 /Height 64 /Filter /DCTDecode ", jpeg.encode_jpeg(RICH[::-1], 90)),
    stream(b"/Type /XObject /Subtype /Image /Width 64 /Height 64 /Filter /JPXDecode ", b"\x00\x00jp2"),
)


class Echo:
    def invoke(self, parts):
        assert all(set(p) in ({"type", "text"}, {"type", "image_url"}) for p in ocr.message(parts))
        ids = [p["text"][5:-2] for p in parts if p["type"] == "text" and p["text"].startswith("[ID: ")]
        return "".join(f"<{i}>seen {i[:4]}</{i}>" for i in ids), 3, 4


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("docs")
    (d / "a.pdf").write_bytes(TWO_PAGES)
    (d / "b.docx").write_bytes(packed({
        "word/document.xml": f'<w:document {W} xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><w:body><w:p><w:r><w:t>before</w:t></w:r></w:p>'
                             '<w:p><w:r><a:blip r:embed="r1"/></w:r></w:p><w:p><w:r><w:t>after</w:t></w:r></w:p></w:body></w:document>',
        "word/_rels/document.xml.rels": '<x><R Id="r1" Target="media/i.png"/></x>'}))
    import io
    import zipfile

    data = io.BytesIO((d / "b.docx").read_bytes())
    with zipfile.ZipFile(data, "a") as z:
        z.writestr("word/media/i.png", images.encode_png(RICH))
    (d / "b.docx").write_bytes(data.getvalue())
    (d / "c.pdf").write_bytes(b"no pdf")
    (d / "d.md").write_text("# é", encoding="utf-8")
    (d / "e.tif").write_bytes(b"II*")
    (d / "f.bin").write_bytes(b"?")
    return str(d)


def read(spark, folder, options, make=Echo, **more):
    f = files.scan(spark, [f"file://{folder}", f"file://{folder}/gone.pdf"], missing="status")
    return {r["path"].rsplit("/", 1)[1]: r for r in document.read_files(spark, f, options, make, **more).collect()}


def seen(folder, name, page, block):
    import hashlib

    return "seen " + hashlib.md5(f"file:{folder}/{name}/{page}/{block}".encode()).hexdigest()[:4]


def test_read_files(spark, folder):
    got = read(spark, folder, ocr.Options(filter_images=False))
    a = ["first line of (two)", "é", "right", seen(folder, "a.pdf", 0, 3), seen(folder, "a.pdf", 0, 4), "last", ""]
    assert got["a.pdf"]["text"] == "\n".join(a) + "\n" + "\n\n" + "page (nested) two\n"
    assert got["b.docx"]["text"] == f"before\n{seen(folder, 'b.docx', 0, 1)}\nafter\n"
    assert {n: (r["kind"], r["text"], r["status"]) for n, r in got.items() if n[0] in "cdefg"} == {
        "c.pdf": ("pdf", "", "open_failed"), "d.md": ("text", "# é", "ok"), "e.tif": ("rejected_image", None, "rejected_image"), "f.bin": ("unsupported", None, "unsupported"), "gone.pdf": ("not_found", None, "not_found")}


def test_filter_dedup_and_scope(spark, folder):
    """The word-processor file's image is a copy of one in the PDF: only the first is sent, or both by document."""
    for scope, last in (("corpus", ""), ("document", seen(folder, "b.docx", 0, 1))):
        got = read(spark, folder, ocr.Options(dedup_scope=scope))
        assert seen(folder, "a.pdf", 0, 3) in got["a.pdf"]["text"] and got["b.docx"]["text"] == f"before\n{last}\nafter\n"
    none = read(spark, folder, ocr.Options(min_score=1.1))
    assert "seen" not in none["a.pdf"]["text"] + none["b.docx"]["text"]
    blind = read(spark, folder, ocr.Options(), detector=lambda x: np.zeros((len(x), 3, 3)))
    assert "seen" not in blind["a.pdf"]["text"]
    sharp = read(spark, folder, ocr.Options(), detector=lambda x: np.full((len(x), 3, 3), 0.8) if x.shape[1:] == (3, 224, 224) else None)
    assert "seen" in sharp["a.pdf"]["text"]


def test_without_ocr(spark, folder):
    got = read(spark, folder, ocr.Options(enable_ocr=False), None)
    assert got["b.docx"]["text"] == "before\nafter\n" and "seen" not in got["a.pdf"]["text"]
    with pytest.raises(RuntimeError):
        read(spark, folder, ocr.Options(), None)


def test_strict_and_watch(spark, folder):
    f = files.scan(spark, f"file://{folder}")
    with pytest.raises(Exception, match="no reader"):
        document.read_files(spark, f, ocr.Options(enable_ocr=False), strict=True).collect()
    watch = Observation("files")
    document.read_files(spark, f, ocr.Options(enable_ocr=False), watch=watch).collect()
    assert watch.get["rows"] == 6 and watch.get["failures"] == 3 and watch.get["characters"] > 20
    with pytest.raises(Exception, match="[Pp]ath"):
        files.scan(spark, f"file://{folder}/gone.pdf").collect()


def test_requests_keep_their_batches(spark):
    rows = [(f"i{k}", "d", k // 3, k % 3, images.encode_png(RICH) if k != 4 else b"bad") for k in range(7)]
    df = spark.createDataFrame(rows, "image_id string, path string, page_no int, block_no int, bytes binary")
    kept = df.where("image_id not in ('i0', 'i1', 'i6')")
    ids = lambda o: {r["batch_no"]: r["ids"] for r in document.requests(df, kept, o, "p").collect()}
    assert ids(ocr.Options(batch_size=2)) == {1: ["i2", "i3"], 2: ["i5"]}
    assert ids(ocr.Options(batch_size=2, rebatch=True)) == {0: ["i2", "i3"], 1: ["i5"]}


def test_retries(spark):
    class Flaky:
        def __init__(self):
            self.n = 0

        def invoke(self, parts):
            self.n += 1
            if parts[0]["text"] == "bug":
                raise TypeError(f"a bug, call {self.n}")
            if self.n < 3:
                raise ConnectionError("down")
            return f"answer {self.n}", 1, 1

    df = spark.createDataFrame([(1, 0, ["x"], "Read."), (1, 1, ["y"], "bug")], "doc_id long, batch_no int, ids array<string>, prompt string").coalesce(1)
    calls = df.withColumn("parts", F.array(F.struct(F.lit("text").alias("type"), F.col("prompt").alias("text"))))
    got = {r["batch_no"]: (r["reply"], r["error"]) for r in ocr.call(calls, Flaky, wait=0).collect()}
    assert got[0] == ("answer 3", None) and got[1][1].startswith("a bug, call 4")  # one attempt only
    with pytest.raises(Exception, match="invoke"):
        ocr.call(calls, lambda: object()).collect()


def test_messages_and_prompt(tmp_path):
    part = lambda **k: {"type": None, "text": None, "url": None, "media_type": None, "data": None} | k
    assert ocr.message([part(type="text", text="p"), part(type="image_url", url="data:x"), part(type="image", media_type="image/png", data="QQ==")]) == [
        {"type": "text", "text": "p"}, {"type": "image_url", "image_url": {"url": "data:x"}}, {"type": "image", "source": {"type": "base64", "media_type": "image/png", "data": "QQ=="}}]
    assert ocr.contents([part(type="text", text="Image 1. Image ID: i"), part(type="image", media_type="image/jpeg", data="QQ=="), part(type="text", text="Read.")]) == [
        {"role": "user", "parts": [{"text": "Image 1. Image ID: i"}, {"inline_data": {"mime_type": "image/jpeg", "data": b"A"}}]}, {"role": "user", "parts": [{"text": "Read."}]}]
    (tmp_path / "p.md").write_text("own prompt")
    assert ocr.load_prompt(str(tmp_path / "p.md")) == "own prompt" and ocr.load_prompt(str(tmp_path / "none.md")) == ocr.load_prompt(None) == ocr.DEFAULT_PROMPT
    local = ocr.LocalOcr(lambda data: [([], (f"line of {data}", 0.9)), ([], ("two ", 0.5))])
    assert local.invoke([part(type="text", text="[ID: i]\n"), part(type="image_url", url="u")])[0] == "<i>\nline of u\ntwo\n</i>"


def test_resize_by_hand():
    """Against loops over the windowed sinc; sides that keep their length are copied."""
    v = RNG.integers(0, 255, (23, 31)).astype(np.uint8)
    for w, h in ((9, 8), (100, 100), (31, 8), (23, 23), (1, 1)):
        out = v.astype(int)
        for axis, n in ((1, w), (0, h)):
            size = out.shape[axis]
            if n == size:
                continue
            wide = max(size / n, 1)
            lines = []
            for o in range(n):
                c = (o + 0.5) * size / n
                taps = {i: np.sinc(x) * np.sinc(x / 3) for i in range(max(0, int(c - 3 * wide + 0.5)), min(size, int(c + 3 * wide + 0.5))) if abs(x := (i + 0.5 - c) / wide) < 3}
                total = sum(taps.values())
                lines.append(sum(np.take(out, i, axis) * int(np.floor(k / total * (1 << 22) + 0.5)) for i, k in taps.items()) + (1 << 21) >> 22)
            out = np.clip(np.stack(lines, axis), 0, 255)
        assert (raster.resize(v, w, h) == out).all()
    small = raster.resize(v, 9, 8).astype(int)
    bits = "".join("1" if small[y, x + 1] > small[y, x] else "0" for y in range(8) for x in range(8))
    assert raster.dhash(v) == f"{int(bits, 2):016x}"


def test_image_bytes():
    for px in (RICH, RICH[..., 0], np.dstack([RICH, RICH[..., 0]]), RICH[..., :2]):
        assert (images.decode_png(images.encode_png(px), alpha=True) == px).all()
    smooth = np.add.outer(np.arange(50), np.arange(70)).astype(np.uint8)
    for q in (85, 90):
        assert np.abs(images.decode(jpeg.encode_jpeg(smooth, q)).astype(int) - smooth).max() <= 6
    data, kind = images.payload(images.encode_png(np.dstack([RICH, RICH[..., 0]])), (32, 48))
    assert kind == "image/png" and images.decode(data, alpha=True).shape == (32, 32, 4)
    data, kind = images.payload(images.encode_png(RICH))
    assert kind == "image/jpeg" and images.decode(data).shape == (64, 64, 3) and images.mode(data) == "RGB"
    assert images.decode(images.jpeg_bytes(images.encode_png(np.dstack([RICH, RICH[..., 0]])))).shape == (64, 64, 3)
    for bad in (b"", b"\x89PNG", b"\xff\xd8\xff\xd9", b"GIF89a"):
        with pytest.raises(Exception):  # noqa: B017, PT011
            images.decode(bad)


def test_jpeg_of_the_jvm(spark, tmp_path):
    """Our reader on a file that the JVM wrote, and the JVM's on ours."""
    jvm, (h, w) = spark._jvm, (37, 45)
    made = jvm.java.awt.image.BufferedImage(w, h, 1)
    for y in range(h):
        for x in range(w):
            made.setRGB(x, y, (5 * x % 256) << 16 | (6 * y % 256) << 8 | (2 * (x + y)))
    jvm.javax.imageio.ImageIO.write(made, "jpg", jvm.java.io.File(str(tmp_path / "a.jpg")))
    (tmp_path / "b.jpg").write_bytes(jpeg.encode_jpeg(RICH[:37, :45], 85))
    for r in images.read(spark, str(tmp_path)).collect():
        theirs = images.rgb(r["bgr"], r["height"], r["width"], r["nChannels"]).astype(int)
        ours = images.decode((tmp_path / r["path"].rsplit("/", 1)[1]).read_bytes())
        assert np.abs(theirs - ours).mean() < 1.5 and np.abs(theirs - ours).max() <= 12


def test_png_kinds():
    import struct

    def chunked(kind, depth, width, height, body, palette=b""):
        part = lambda n, d: struct.pack(">I", len(d)) + n + d + b"\0\0\0\0"
        return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, kind, 0, 0, 0)) + (part(b"PLTE", palette) if palette else b"") + part(b"IDAT", zlib.compress(body))

    assert images.decode(chunked(0, 1, 9, 1, b"\0\xaa\x80")).tolist() == [[255, 0, 255, 0, 255, 0, 255, 0, 255]]
    assert images.decode(chunked(3, 2, 3, 1, b"\0\x18", b"\1\2\3\4\5\6\7\x08\x09")).tolist() == [[[1, 2, 3], [4, 5, 6], [7, 8, 9]]]
    assert images.decode(chunked(0, 16, 2, 1, b"\0\x12\x34\x56\x78")).tolist() == [[0x12, 0x56]]
    assert images.decode(chunked(0, 8, 3, 3, b"\1\1\1\1" + b"\2\1\1\1" + b"\4\1\0\0")).tolist() == [[1, 2, 3], [2, 3, 4], [3, 3, 4]]
    assert images.mode(chunked(3, 8, 1, 1, b"\0\0")) == "P"


def test_text_presence_and_detector_input():
    assert raster.text_present(None, [RICH, RICH]) == [True, True]
    assert raster.text_present(lambda x: [m.mean() * 0 + 0.8 for m in x], [RICH]) == [True]
    assert raster.text_present(lambda x: [np.zeros(3) for _ in x], [RICH]) == [False]
    assert raster.text_present(lambda x: 1 / 0, [RICH]) == [False]
    flat = np.full((100, 50, 3), 200, np.uint8)
    x = raster.detector_input(flat)
    assert x.shape == (3, 224, 224) and np.allclose(x[:, 0, 0], 200 - np.array(raster.MEANS), atol=1e-3)


def test_metric_branches():
    tiny = np.arange(36 * 36, dtype=np.uint8).reshape(36, 36)
    assert raster.metrics(tiny)["density"] == 0.5  # cells under ten pixels
    many = np.dstack([*np.meshgrid(np.arange(128), np.arange(128), indexing="ij"), np.zeros((128, 128))]).astype(np.uint8)
    assert raster.metrics(many)["color"] == 1.0  # over the limit of colours
    assert [raster.edge_score(x) for x in (0.015, 0.03, 0.1, 0.2)] == [0.5, 0.5, 1.0, 1.0]
    assert [raster.brightness(x) for x in (10, 100, 237.5, 250)] == [0.0, 1.0, 0.5, 0.0]


def test_first_seen_rows(spark):
    df = spark.createDataFrame([("h", 1), ("h", 1), ("h", 2), (None, 3), (None, 4), ("g", None)], "dhash string, i long")
    got = sorted(((r["dhash"], r["i"]) for r in assemble.first_seen(df, "dhash", ("i",)).collect()), key=str)
    assert got == sorted([("h", 1), (None, 3), (None, 4), ("g", None)], key=str)


def test_blocks_and_names(spark):
    lines = [([(["a ", " b"],), (["c"],)], 0, None), (None, 1, "x"), (None, 7, "y")]
    df = spark.createDataFrame([([{"spans": [{"text": t} for t in s[0]]} for s in ls] if ls else None, k, i) for ls, k, i in lines], "lines array<struct<spans:array<struct<text:string>>>>, block_type int, image_id string")
    assert [r["text"] for r in assemble.block_text(df).collect()] == ["a b c\n", "Image-Placeholder{x}\n"]
    names = spark.createDataFrame([("/a/b/c.tar.gz",), (".hidden",), ("x",)], "p string").select(T.stem(F.col("p")), T.folder(F.col("p")), T.preview(F.col("p"), 2)).collect()
    assert [tuple(r) for r in names] == [("c.tar", "/a/b", "/a"), (".hidden", "", ".h"), ("x", "", "x")]


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "h string, s int").withColumn("at", F.timestamp_seconds("s"))
    rows.write.parquet(src)
    s = streams.stream(spark, src, rows.schema)
    streams.each_batch(s, lambda df: df.dropDuplicates(["h"]), out, str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    streams.dedup(s, "h", "at").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c2")).option("path", f"{out}2").trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(f"{out}2").count() == 2
    files.write_text(rows.select(F.col("h").alias("text")), f"{out}3")
    assert sorted(r["value"] for r in spark.read.text(f"{out}3").collect()) == ["a", "a", "b"]


def test_odd_shapes(spark, folder):
    """The four cases of the rule, at their edges; and the option that asks for it."""
    sizes = [(99, 99), (100, 99), (99, 100), (100, 286), (100, 285), (501, 79), (501, 80), (500, 200), (79, 501), (200, 200)]
    df = spark.createDataFrame(sizes, "w int, h int").select("w", "h", raster.odd_shape(F.col("w"), F.col("h")).alias("odd"))
    assert [r["odd"] for r in df.collect()] == [True, False, False, True, False, True, True, False, True, False]
    kept = read(spark, folder, ocr.Options())
    none = read(spark, folder, ocr.Options(odd_shapes=True))  # the pictures here are 64 by 64
    assert "seen" in kept["a.pdf"]["text"] and "seen" not in none["a.pdf"]["text"]


def test_skipped_images_leave_a_message(spark, folder):
    got = read(spark, folder, ocr.Options(min_score=1.1, mark_skipped=True))
    assert got["b.docx"]["text"] == f"before\n{T.NO_MEANING}\nafter\n"
    assert got["a.pdf"]["text"].count(T.NO_MEANING) == 3


def test_gray_of_colours(spark, tmp_path):
    """Luma in whole numbers against the formula, for every channel and mixed; and colour pictures through the scores."""
    px = RNG.integers(0, 256, (50, 60, 3)).astype(np.uint8)
    px[0, :3] = [[255, 0, 0], [0, 255, 0], [0, 0, 255]]
    want = np.floor((px.astype(float) * [19595, 38470, 7471]).sum(2) / 65536 + 0.5).astype(int)
    assert (raster.gray(px) == want).all() and raster.gray(px)[0, :3].tolist() == [76, 150, 29]
    assert np.abs(want - px.astype(float) @ [0.299, 0.587, 0.114]).max() <= 0.51
    df = spark.createDataFrame([("a", images.encode_png(px)), ("b", images.encode_png(raster.gray(px)))], "image_id string, bytes binary")
    got = {r["image_id"]: r for r in raster.score(df, images.decode).collect()}
    assert got["a"]["dhash"] == got["b"]["dhash"] == raster.dhash(raster.gray(px))
    assert got["a"]["entropy"] == got["b"]["entropy"] and got["a"]["uniqueness"] > got["b"]["uniqueness"]


def test_folder_goes_with_the_jvm(tmp_path):
    """Intermediate tables are gone when the program has ended, also after spark.stop()."""
    import os
    import subprocess

    code = (f"import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})\n"
            "from pyspark.sql import SparkSession\nfrom quire.storage import Table\n"
            f"s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', 'file://{tmp_path}/ck').getOrCreate()\n"
            f"t = Table(s, s.range(5))\nimport os\nassert t.df.count() == 5 and os.listdir('{tmp_path}/ck')\ns.stop()\n")  # fmt: skip
    subprocess.run([sys.executable, "-c", code], check=True, timeout=200, capture_output=True)
    assert not [n for n in os.listdir(tmp_path / "ck") if n.startswith("quire-")]
