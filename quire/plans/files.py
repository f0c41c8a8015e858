"""Queries over files made of the tables: spreadsheets and colour pictures, by the readers that files go through."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..operators import document, ocr, raster
from ..sources import files, images
from .queries import query, read

SHEET_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def _workbook(sheets: dict[str, list[list[object]]]) -> bytes:
    """A spreadsheet file: numbers as numbers, texts inline, None as an empty cell."""
    out = io.BytesIO()
    cell = lambda at, v: "" if v is None else f'<c r="{at}"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{at}" t="inlineStr"><is><t>{v}</t></is></c>'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {SHEET_NS}><sheets>{''.join(f'<sheet name="{n}" r:id="r{i}"/>' for i, n in enumerate(sheets))}</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f"<x>{''.join(f'<R Id="r{i}" Target="worksheets/{i}.xml"/>' for i in range(len(sheets)))}</x>")
        for i, rows in enumerate(sheets.values()):
            lines = "".join(f'<row r="{n}">{"".join(cell(f"{chr(65 + k)}{n}", v) for k, v in enumerate(r))}</row>' for n, r in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/{i}.xml", f"<worksheet {SHEET_NS}><sheetData>{lines}</sheetData></worksheet>")
    return out.getvalue()


@query("""
WITH t AS (SELECT conv_id, turn, role, length(text) AS n FROM conversations),
one AS (SELECT conv_id, '## turns' || chr(10) || '| turn |  | role |' || chr(10) || '| --- | --- | --- |' || string_agg(chr(10) || '| ' || turn || ' | ' || CASE WHEN n % 2 = 0 THEN CAST(n AS VARCHAR) ELSE '' END || ' | ' || role || ' |', '' ORDER BY turn) AS text FROM t GROUP BY conv_id),
two AS (SELECT conv_id, '## sums' || chr(10) || '| turns |' || chr(10) || '| --- |' || chr(10) || '| ' || count(*) || ' |' AS text FROM t GROUP BY conv_id)
SELECT 'in/' || conv_id || '.xlsx' AS path, 0::INT AS part_no, 'excel' AS kind, text, 'ok' AS status FROM one UNION ALL SELECT 'in/' || conv_id || '.xlsx', 1, 'excel', text, 'ok' FROM two""")
def read_sheets(spark, sf):
    """Spreadsheets of two sheets, with an empty header and empty cells, by the library's one call."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [_workbook({"turns": [["turn", None, "role"], *[[int(t["turn"]), int(t["n"]) if t["n"] % 2 == 0 else None, t["role"]] for t in ts]], "sums": [["turns"], [len(ts)]]}) for ts in f["ts"]]
            yield pd.DataFrame({"path": f["path"], "content": made})

    c = read(spark, sf, "conversations")
    books = c.groupBy(F.concat(F.lit("in/"), F.col("conv_id").cast("string"), F.lit(".xlsx")).alias("path")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.length("text").alias("n")))).alias("ts"))
    content = books.mapInPandas(build, "path string, content binary")
    return document.read_files(spark, files.routed(content), ocr.Options(enable_ocr=False))


SIDE = 40


@query(f"""
WITH v AS (SELECT vec_id, embedding AS e FROM embeddings),
p AS (SELECT vec_id, x, y, CAST([floor(abs(CAST(e[(x * 7 + y * 13 + c * 29) % 64 + 1] AS DOUBLE)) * 2550) % 256 FOR c IN [0, 1, 2]] AS BIGINT[]) AS px FROM v, range({SIDE}) AS a(x), range({SIDE}) AS b(y)),
g AS (SELECT vec_id, px, (19595 * px[1] + 38470 * px[2] + 7471 * px[3] + 32768) >> 16 AS luma FROM p)
SELECT vec_id, CAST(sum(luma) AS BIGINT) AS luma, CAST(min(luma) AS INT) AS darkest, CAST(max(luma) AS INT) AS lightest, CAST(count(DISTINCT px) AS INT) AS n_colors FROM g GROUP BY vec_id""")
def colour_pictures(spark, sf):
    """Colour pictures drawn from the embeddings, encoded as files, decoded again: their gray values and their colours."""

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        y, x, c = np.meshgrid(np.arange(SIDE), np.arange(SIDE), np.arange(3), indexing="ij")
        at = (x * 7 + y * 13 + c * 29) % 64
        for f in frames:
            rows = []
            for i, e in zip(f["vec_id"], f["embedding"], strict=True):
                drawn = (np.floor(np.abs(np.asarray(e, np.float64)) * 2550) % 256).astype(np.uint8)[at]
                px = images.decode(images.encode_png(drawn))
                luma = raster.gray(px).astype(int)
                rows.append((i, luma.sum(), luma.min(), luma.max(), raster.colors(px)))
            yield pd.DataFrame(rows, columns=["vec_id", "luma", "darkest", "lightest", "n_colors"])

    return read(spark, sf, "embeddings").select("vec_id", "embedding").mapInPandas(measure, "vec_id long, luma long, darkest int, lightest int, n_colors int")
