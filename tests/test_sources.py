"""Readers and OCR calls on files made here."""

import io
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import assemble as A
from quire.operators import ocr, raster
from quire.sources import files, images

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def packed(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def png(v):
    chunk = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    h, w = v.shape
    body = zlib.compress(b"".join(b"\0" + r.tobytes() for r in v))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", body) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("in")
    (d / "a.docx").write_bytes(packed({"word/document.xml": f"<w:document {W}><w:body><w:p><w:r><w:t>one two</w:t></w:r></w:p></w:body></w:document>"}))
    (d / "b.xlsx").write_bytes(packed({
        "xl/workbook.xml": f'<workbook {S}><sheets><sheet name="First" r:id="r1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<x><R Id="r1" Target="worksheets/s.xml"/></x>',
        "xl/worksheets/s.xml": f'<worksheet {S}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>h</t></is></c></row><row r="2"><c r="A2"><v>5</v></c><c r="B2"><v>7</v></c></row></sheetData></worksheet>'}))
    content = zlib.compress(b"BT (Hello \\(pdf\\)) Tj T* (next) Tj ET")
    (d / "c.pdf").write_bytes(b"%PDF-1.4\n1 0 obj << /Type /Page /Contents 2 0 R >> endobj\n2 0 obj << /Filter /FlateDecode >> stream\n" + content + b"\nendstream endobj\n")
    (d / "broken.pdf").write_bytes(b"nothing")
    (d / "d.TXT").write_text("plain é", encoding="utf-8")
    (d / "e.png").write_bytes(png(np.zeros((40, 40), np.uint8)))
    return str(d)


def test_files(spark, folder):
    f = files.scan(spark, f"file://{folder}").cache()
    kinds = {r["path"].rsplit("/", 1)[1]: r["kind"] for r in f.select("path", "kind").collect()}
    assert kinds == {"a.docx": "docx", "b.xlsx": "excel", "c.pdf": "pdf", "broken.pdf": "pdf", "d.TXT": "text", "e.png": "rejected_image"}
    assert [r["text"] for r in files.texts(f).collect()] == ["plain é"]
    rows = files.blocks(f).collect()
    assert sorted(r["text"] for r in rows if r["block_type"] == 0) == ["Hello (pdf)\nnext", "one two"]
    assert [r["path"][-10:] for r in rows if r["status"] == "open_failed"] == ["broken.pdf"]
    (sheet,) = files.sheets(f).collect()
    assert sheet["text"].startswith("## First\n| h |") and "5 | 7" in sheet["text"] and "NaN" not in sheet["text"] and "Unnamed" not in sheet["text"]


def test_ocr(spark):
    class Fake:
        def invoke(self, parts):
            ids = [p["text"][5:-2] for p in parts if p["type"] == "text" and p["text"].startswith("[ID")]
            if any(i.startswith("ffff") for i in ids):
                raise RuntimeError("down")
            return "\n".join(f"<{i}>first</{i}><{i}> read {i[:2]} </{i}>" for i in ids if not i.startswith("eeee")), 3, 4

    i = lambda c: f"{c * 8}-{c * 4}-{c * 4}-{c * 4}-{c * 12}"
    rows = [(1, 0, [i("a"), i("e")]), (1, 1, [i("f")])]
    b = spark.createDataFrame(rows, "doc_id long, batch_no int, ids array<string>")
    parts = F.transform("ids", lambda x: F.struct(x.alias("image_id"), F.lit("image/png").alias("media_type"), F.lit("AA==").alias("b64")))
    out = ocr.parse(ocr.call(b.withColumn("parts", A.prompt_parts(parts, "Read.")), Fake, max_retries=0)).collect()
    assert {r["image_id"][0]: (r["content"], r["status"]) for r in out} == {
        "a": ("read aa", "ok"), "e": ("[OCR FAILED: Model did not return content for this ID]", "no_content"), "f": ("[OCR FAILED: API Error - down]", "api_error")}
    with pytest.raises(ValueError):
        ocr.Options(batch_size=6)


def test_images(spark):
    r = np.random.default_rng(1)
    v = r.integers(0, 255, (64, 48)).astype(np.uint8)
    assert (images.decode_png(png(v)) == v).all()
    df = spark.createDataFrame([("a", png(v)), ("b", png(v)), ("c", png(v[:8])), ("d", b"bad")], "image_id string, bytes binary")
    scored = raster.score(df, images.decode_png)
    assert [x["image_id"] for x in raster.meaningful(scored, ("image_id",)).collect()] == ["a"]
    assert {x["image_id"]: x["status"] for x in scored.collect()}["d"] == "decode_failed"
