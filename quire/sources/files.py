"""Files as rows: text, spreadsheets, word-processor files and PDF, by extension. Standard library only."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import map_frames
from ..functions import text as T
from . import images

BLOCKS = "path string, page_no int, block_no int, block_type int, text string, bytes binary, status string"
W_NS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
A_NS = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
R_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


#: The kinds that a reader takes.
READ = ("text", "excel", "docx", "pdf")
FILES = "path string, modificationTime timestamp, length long, content binary"


def scan(spark: SparkSession, paths: str | list[str], missing: str = "error") -> DataFrame:
    """path, ext, kind, content. A missing path is Spark's own error, or with ``missing="status"`` a row of kind ``not_found``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    gone: list[str] = []
    if missing == "status":
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            if not where.getFileSystem(conf).globStatus(where):
                gone.append(p)
        paths = [p for p in paths if p not in gone]
    files = spark.read.format("binaryFile").load(paths) if paths else spark.createDataFrame([], FILES)
    files = routed(files)
    if gone:
        lost = spark.createDataFrame([(p,) for p in gone], "path string").withColumn("ext", T.extension(F.col("path"))).withColumn("kind", F.lit("not_found"))
        files = files.unionByName(lost, allowMissingColumns=True)
    return files


def routed(files: DataFrame) -> DataFrame:
    """Adds ext and kind by the path."""
    return files.withColumn("ext", T.extension(F.col("path"))).withColumn("kind", T.route(F.col("ext")))


def strict(files: DataFrame) -> DataFrame:
    """Raise on files that no reader takes."""
    bad = F.col("kind").isin("rejected_image", "unsupported")
    return files.withColumn("kind", F.when(bad, F.raise_error(F.concat(F.lit("no reader for "), F.col("path")))).otherwise(F.col("kind")))


def texts(files: DataFrame) -> DataFrame:
    return files.where("kind = 'text'").select("path", F.decode("content", "UTF-8").alias("text"))


def sheets_markdown(data: bytes) -> str:
    """Every sheet as ``## name`` and a table; empty cells are NaN, empty headers Unnamed."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = ["".join(t.text or "" for t in si.iter(f"{S_NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{S_NS}sheet"):
            target = rels[sheet.get(f"{R_NS}id")].lstrip("/")
            rows: dict[int, dict[int, str]] = {}
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            for n, row in enumerate(root.iter(f"{S_NS}row"), 1):
                cells = rows.setdefault(int(row.get("r") or n), {})
                for m, c in enumerate(row.iter(f"{S_NS}c"), 1):
                    col = 0
                    for ch in re.match(r"[A-Z]*", c.get("r") or "").group():
                        col = col * 26 + ord(ch) - 64
                    v = c.find(f"{S_NS}v")
                    text = "".join(t.text or "" for t in c.iter(f"{S_NS}t")) if c.get("t") == "inlineStr" else (v.text or "") if v is not None else ""
                    cells[col or m] = shared[int(text)] if c.get("t") == "s" and text else text
            out.append(f"## {sheet.get('name')}")
            if rows:
                width, table = max(max(c, default=0) for c in rows.values()), [rows.get(r, {}) for r in range(min(rows), max(rows) + 1)]
                head = [table[0].get(i) or f"Unnamed: {i - 1}" for i in range(1, width + 1)]
                lines = [head, ["---"] * width, *[[r.get(i) or "NaN" for i in range(1, width + 1)] for r in table[1:]]]
                out.extend("| " + " | ".join(x.replace("\n", " ") for x in line) + " |" for line in lines)
        return "\n".join(out)


def sheets_of(markdown: str) -> list[str]:
    """As ``functions.text.clean_text`` and ``split_sheets``, for one text."""
    clean = re.sub(r"\bNaN\b", "", re.sub(r"Unnamed:\s*\d+", "", markdown))
    return [p.strip() for p in re.split(r"(?m)(?=^## )", clean) if p.strip().startswith("##")]


def docx_blocks(data: bytes) -> list[tuple[int, int, str | None, bytes | None]]:
    """(page, type, text, image) in reading order; a word-processor file is one page."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("word/_rels/document.xml.rels"))} if "word/_rels/document.xml.rels" in names else {}
        out = []
        for p in ElementTree.fromstring(z.read("word/document.xml")).iter(f"{W_NS}p"):
            text = "".join((t.text or "") if t.tag == f"{W_NS}t" else " " for t in p.iter() if t.tag in (f"{W_NS}t", f"{W_NS}tab", f"{W_NS}br"))
            if text.strip():
                out.append((0, 0, text, None))
            for blip in p.iter(f"{A_NS}blip"):
                target = rels.get(blip.get(f"{R_NS}embed"), "")
                name = target.lstrip("/") if target.startswith("/") else f"word/{target}"
                if name in names:
                    out.append((0, 1, None, z.read(name)))
        return out


_OBJ = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)
_NAME = rb"/[^\s/<>\[\](){}%]+"
_TOKEN = re.compile(
    rb"%[^\r\n]*|BI\s.*?\sEI\b|\((?:\\.|\((?:\\.|[^\\()])*\)|[^\\()])*\)|<[0-9A-Fa-f\s]*>|<<|>>|[\[\]]|" + _NAME + rb"|[-+]?(?:\d+\.?\d*|\.\d+)|[A-Za-z'\"*][A-Za-z0-9*]*", re.S
)
_NUMBER = re.compile(rb"[-+.]?[0-9]")


def _pdf_text(token: bytes) -> str:
    if token[:1] == b"<":
        raw = bytes.fromhex((x := re.sub(rb"\s", b"", token[1:-1]).decode()) + "0" * (len(x) % 2))
    else:
        names = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
        raw = re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda m: b"" if m[1].endswith(b"\n") else bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else names.get(m[1], m[1]), token[1:-1], flags=re.S)
    return raw.decode("utf-16") if raw[:2] in (b"\xfe\xff", b"\xff\xfe") else raw.decode("cp1252", "replace")


def _times(a: tuple, b: tuple) -> tuple:
    return (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3], a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5])


def _content(data: bytes) -> list[tuple[float, float, str | None, bytes | None]]:
    """(x, y, text, image name) of what a page's content stream shows: a text object is one block, at its first string."""
    out, args, saved = [], [], []
    ctm = line = at = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
    leading, first, parts, inside = 0.0, None, [], False

    def move(x: float, y: float) -> None:
        nonlocal line, at
        line = at = _times((1.0, 0.0, 0.0, 1.0, x, y), line)
        parts.append("\n" if y else " ")

    def show(t: str) -> None:
        nonlocal first
        if first is None:
            first = _times(at, ctm)
        parts.append(t)

    for m in _TOKEN.finditer(data):
        t = m.group()
        if t[:1] in (b"(", b"/") or t[:1] == b"<" and t != b"<<" or _NUMBER.match(t):
            args.append(t)
            continue
        if t in (b"[", b"]", b"<<", b">>") or t[:1] == b"%" or t[:2] == b"BI":
            continue
        numbers = [float(x) for x in args if _NUMBER.match(x)]
        if t == b"q":
            saved.append(ctm)
        elif t == b"Q" and saved:
            ctm = saved.pop()
        elif t == b"cm" and len(numbers) >= 6:
            ctm = _times(tuple(numbers[-6:]), ctm)
        elif t == b"BT":
            line = at = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
            first, parts, inside = None, [], True
        elif t == b"Tm" and len(numbers) >= 6:
            line = at = tuple(numbers[-6:])
            parts.append("\n")
        elif t in (b"Td", b"TD") and len(numbers) >= 2:
            leading = -numbers[-1] if t == b"TD" else leading
            move(*numbers[-2:])
        elif t == b"TL" and numbers:
            leading = numbers[-1]
        elif t == b"T*":
            move(0.0, -leading or -1.0)
        elif t in (b"Tj", b"'", b'"', b"TJ") and inside:
            if t in (b"'", b'"'):
                move(0.0, -leading or -1.0)
            for x in args:
                if x[:1] in (b"(", b"<"):
                    show(_pdf_text(x))
                elif t == b"TJ" and _NUMBER.match(x) and float(x) < -200:  # a gap as wide as a space
                    parts.append(" ")
        elif t == b"ET":
            if "".join(parts).strip():
                out.append((first[4], first[5], "".join(parts).strip("\n"), None))
            inside = False
        elif t == b"Do" and args and args[-1][:1] == b"/":
            out.append((ctm[4], ctm[5] + ctm[3], None, args[-1]))
        args = []
    return out


def _pdf_image(head: bytes, raw: bytes, unfiltered: bytes) -> bytes:
    """The bytes of an image object: a JPEG as it is, plain 8-bit pixels as PNG, anything else raw (no reader will take it)."""
    if b"/DCTDecode" in head:
        return raw
    width, height = (int(m[1]) if (m := re.search(rb"/" + n + rb"\s+(\d+)", head)) else 0 for n in (b"Width", b"Height"))
    channels = 3 if b"/DeviceRGB" in head else 1 if b"/DeviceGray" in head else 0
    plain = re.search(rb"/BitsPerComponent\s+8\b", head) and not re.search(rb"/(JPXDecode|CCITTFaxDecode|JBIG2Decode|Predictor)", head)
    if plain and channels and width and len(unfiltered) >= width * height * channels:
        px = np.frombuffer(unfiltered[: width * height * channels], np.uint8).reshape(height, width, channels)
        return images.encode_png(px)
    return raw


def pdf_blocks(data: bytes) -> list[tuple[int, int, str | None, bytes | None]]:
    """A small reader: pages in the order of their tree, blocks from top to bottom, then left to right.

    Flate and hex streams, literal and hex strings, every image object. Best effort: fonts with encodings of
    their own are read as if they had none. An image that no reader takes keeps its block, and fails when it is decoded.
    """
    if not data.startswith(b"%PDF"):
        raise ValueError("not a PDF")
    objects = {int(n): body for n, body in _OBJ.findall(data)}

    def stream(body: bytes) -> tuple[bytes, bytes, bytes]:
        """Head, raw bytes, and the bytes without the filters that are known."""
        m = _STREAM.search(body)
        head, raw = (body[: m.start()], m[1]) if m else (body, b"")
        out = raw
        if b"/ASCIIHexDecode" in head:
            out = bytes.fromhex(re.sub(rb"[^0-9A-Fa-f]", b"", out.split(b">")[0]).decode())
        if b"/FlateDecode" in head:
            out = zlib.decompressobj().decompress(out)
        return head, raw, out

    for body in list(objects.values()):  # objects within object streams
        if re.search(rb"/Type\s*/ObjStm", body):
            raw = stream(body)[2]
            first = int(re.search(rb"/First\s+(\d+)", body)[1])
            nums = list(map(int, raw[:first].split()))
            for i in range(0, len(nums), 2):
                end = nums[i + 3] if i + 3 < len(nums) else len(raw) - first
                objects.setdefault(nums[i], raw[first + nums[i + 1] : first + end])
    refs = lambda x: [int(n) for n in re.findall(rb"(\d+)\s+\d+\s+R", x)]
    is_page = lambda body: re.search(rb"/Type\s*/Page\b", body.split(b"stream", 1)[0])
    order, todo, seen = [], [int(m[1]) for b in objects.values() if re.search(rb"/Type\s*/Catalog", b) and (m := re.search(rb"/Pages\s+(\d+)", b))][:1], set()
    while todo:
        n = todo.pop()
        if n in seen or n not in objects:
            continue
        seen.add(n)
        if kids := re.search(rb"/Kids\s*\[([^\]]*)\]", objects[n]):
            todo.extend(reversed(refs(kids[1])))
        elif is_page(objects[n]):
            order.append(n)
    out = []
    for page_no, n in enumerate(order or [n for n, body in objects.items() if is_page(body)]):
        body = objects[n]
        contents = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
        resources = body
        parent = re.search(rb"/Parent\s+(\d+)", body)
        if b"/Resources" not in body and parent:
            resources += objects.get(int(parent[1]), b"")
        if m := re.search(rb"/Resources\s+(\d+)\s+\d+\s+R", resources):
            resources += objects.get(int(m[1]), b"")
        if m := re.search(rb"/XObject\s+(\d+)\s+\d+\s+R", resources):
            resources += objects.get(int(m[1]), b"")
        named = {k: int(r) for k, r in re.findall(rb"(" + _NAME + rb")\s+(\d+)\s+\d+\s+R", resources)}
        shown = _content(b"\n".join(stream(objects[r])[2] for r in (refs(contents[1]) if contents else []) if r in objects))
        for _, _, text, image in sorted(shown, key=lambda s: (-round(s[1]), s[0])):
            if text is not None:
                out.append((page_no, 0, text, None))
            elif (x := objects.get(named.get(image, -1))) and re.search(rb"/Subtype\s*/Image", x):
                out.append((page_no, 1, None, _pdf_image(*stream(x))))
        out.append((page_no, -1, None, None))  # a page is a page, even an empty one
    return out


#: Block types beyond a document's own: a whole text, a spreadsheet's markdown, and the mark that a page is there.
WHOLE, SHEETS, PAGE = 2, 3, -1


def parts(files: DataFrame) -> DataFrame:
    """All files in one reading: the blocks of PDF and word-processor files, texts and spreadsheets as one row each, and a row with its kind as status for what no reader takes."""

    def one(path: str, kind: str, ext: str, data: bytes) -> list[tuple]:
        if kind == "text":
            return [(path, 0, 0, WHOLE, data.decode("utf-8", "replace"), None, "ok")]
        if kind == "excel":
            return [(path, 0, 0, SHEETS, None, None, "unsupported") if ext == ".xls" else (path, 0, 0, SHEETS, sheets_markdown(data), None, "ok")]
        found = (docx_blocks if kind == "docx" else pdf_blocks)(data)
        found.append((found[-1][0] if found else 0, PAGE, None, None))  # a file is a file, even an empty one
        return [(path, p, i, k, t, b, "ok") for i, (p, k, t, b) in enumerate(found)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, kind, ext, data in zip(f["path"], f["kind"], f["ext"], f["content"], strict=True):
                if kind not in READ:
                    rows.append((path, 0, 0, WHOLE, None, None, kind))
                    continue
                try:
                    rows.extend(one(path, kind, ext, bytes(data)))
                except Exception:  # the file's own failure, reported in its row
                    rows.append((path, 0, 0, {"text": WHOLE, "excel": SHEETS}.get(kind, PAGE), None, None, "open_failed"))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCKS.split(", ")]).astype({"page_no": "Int32", "block_no": "Int32", "block_type": "Int32"})

    content = F.when(F.col("kind").isin(*READ), F.col("content"))
    return map_frames(files.select("path", "kind", "ext", content.alias("content")), run, BLOCKS)


def blocks(files: DataFrame) -> DataFrame:
    """Blocks of word-processor and PDF files. A file that cannot be opened is one row with a status."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, kind, data in zip(f["path"], f["kind"], f["content"], strict=True):
                try:
                    found = (docx_blocks if kind == "docx" else pdf_blocks)(bytes(data))
                    found.append((found[-1][0] if found else 0, -1, None, None))  # a file is a file, even an empty one
                    rows.extend((path, p, i, k, t, b, "ok") for i, (p, k, t, b) in enumerate(found))
                except Exception:
                    rows.append((path, None, None, None, None, None, "open_failed"))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCKS.split(", ")]).astype({"page_no": "Int32", "block_no": "Int32", "block_type": "Int32"})

    return map_frames(files.where("kind in ('docx', 'pdf')").select("path", "kind", "content"), run, BLOCKS)


def sheets(files: DataFrame) -> DataFrame:
    """path, sheet_no, text, status of every sheet; ``.xls`` is reported as unsupported."""

    @F.pandas_udf("struct<text:string,status:string>")
    def markdown(ext: pd.Series, content: pd.Series) -> pd.DataFrame:
        rows = []
        for e, c in zip(ext, content, strict=True):
            try:
                rows.append((None, "unsupported") if e == ".xls" else (sheets_markdown(bytes(c)), "ok"))
            except Exception:
                rows.append((None, "open_failed"))
        return pd.DataFrame(rows, columns=["text", "status"])

    read = files.where("kind = 'excel'").select("path", markdown("ext", "content").alias("m"))
    return split(read.select("path", "m.text", "m.status"))


def split(books: DataFrame) -> DataFrame:
    """path, sheet_no, text, status of the sheets of spreadsheets in markdown; one without sheets is one row."""
    return books.select("path", F.posexplode_outer(T.split_sheets(T.clean_text(F.col("text")))).alias("sheet_no", "text"), "status")


def write_text(docs: DataFrame, path: str, column: str = "text") -> None:
    docs.select(column).write.mode("overwrite").text(path, lineSep="\n")
