"""Column functions for text, identifiers and replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
WHITE = r"[\p{IsWhite_Space}\x1c-\x1f]"
PLACEHOLDER = r"Image-Placeholder\{([a-fA-F0-9-]+)\}"
SEGMENT = r"(?s)<([0-9a-fA-F-]{36})>\s*(.*?)\s*</\1>"
API_ERROR = "[OCR FAILED: API Error - %s]"
NO_CONTENT = "[OCR FAILED: Model did not return content for this ID]"
SKIPPED = "[Image skipped: Low quality/no text detected]"
NO_MEANING = "[SKIPPED: No meaningful content detected]"
UNNAMED, NOT_A_NUMBER = r"(?U)Unnamed:\s*\d+", r"(?U)\bNaN\b"
EXTENSIONS = {".xlsx": "excel", ".xls": "excel", ".pdf": "pdf", ".docx": "docx", ".txt": "text", ".md": "text"}
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".bmp", ".tiff", ".tif")


def collapse(t: Column) -> Column:
    """All white space runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(t, WHITE + "+", " "))


def block_line(t: Column) -> Column:
    return F.concat(collapse(t), F.lit("\n"))


def strip(t: Column) -> Column:
    return F.regexp_replace(t, rf"^{WHITE}+|{WHITE}+$", "")


def spans_text(lines: Column) -> Column:
    """lines: array of structs with spans, an array of structs with text."""
    return F.concat_ws(" ", F.flatten(F.transform(lines, lambda x: F.transform(x["spans"], lambda s: s["text"]))))


def clean_text(t: Column) -> Column:
    """Without the marks that a spreadsheet's empty headers and cells leave."""
    return F.regexp_replace(F.regexp_replace(t, UNNAMED, ""), NOT_A_NUMBER, "")


def split_sheets(t: Column) -> Column:
    parts = F.transform(F.split(t, r"(?md)(?=^## )"), strip)
    return F.filter(parts, lambda x: F.startswith(x, F.lit("##")))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    """The file's name without its last suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def preview(t: Column, n: int = 500) -> Column:
    return F.left(t, F.lit(n))


def route(ext: Column) -> Column:
    """The reader for an extension, ``rejected_image`` or ``unsupported``."""
    out = F.when(ext.isin(*IMAGE_EXTENSIONS), "rejected_image")
    for e, kind in EXTENSIONS.items():
        out = out.when(ext == e, kind)
    return out.otherwise("unsupported")


def image_id(*key: Column) -> Column:
    """A stable id of 36 characters from the block's key."""
    h = F.md5(F.concat_ws("/", *[k.cast("string") for k in key]))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def placeholder(image_id_: Column) -> Column:
    return F.concat(F.lit("Image-Placeholder{"), image_id_, F.lit("}\n"))


def placeholder_ids(t: Column) -> Column:
    return F.regexp_extract_all(t, F.lit(PLACEHOLDER), F.lit(1))


def splice(t: Column, replies: Column) -> Column:
    """Each placeholder of t, in order, replaced by its text in the map; without one by nothing."""
    return F.aggregate(placeholder_ids(t), t, lambda acc, i: F.replace(acc, F.concat(F.lit("Image-Placeholder{"), i, F.lit("}")), strip(F.coalesce(F.try_element_at(replies, i), F.lit("")))))


def segments(reply: Column) -> Column:
    """The tagged segments of a reply: array of (id, content), in order, repeats included."""
    ids, texts = (F.regexp_extract_all(reply, F.lit(SEGMENT), F.lit(g)) for g in (1, 2))
    return F.transform(F.arrays_zip(ids.alias("id"), texts.alias("content")), lambda s: F.struct(s["id"].alias("id"), strip(s["content"]).alias("content")))


def valid_id(i: Column) -> Column:
    return F.coalesce((strip(i) != "") & ~F.contains(i, F.lit("]")) & ~F.contains(i, F.lit("\n")), F.lit(False))


def media_type(mode: Column) -> Column:
    return F.when(mode.isin("RGBA", "LA", "P"), "image/png").otherwise("image/jpeg")


def base64_text(data: Column) -> Column:
    return F.regexp_replace(F.base64(data), r"[\r\n]", "")


def png_mode(data: Column) -> Column:
    """The mode of a PNG or GIF by its header; of anything else RGB."""
    kind = F.conv(F.hex(F.substring(data, 26, 1)), 16, 10).cast("int")
    png = F.hex(F.substring(data, 1, 8)) == "89504E470D0A1A0A"
    return F.when(png & (kind == 0), "L").when(png & (kind == 3), "P").when(png & (kind == 4), "LA").when(png & (kind == 6), "RGBA").when(F.hex(F.substring(data, 1, 4)) == "47494638", "P").otherwise("RGB")


def thumbnail_size(width: Column, height: Column, limit: tuple[int, int] = (2048, 2048)) -> Column:
    """Shrink only, aspect kept: (width, height)."""
    scale = F.least(F.lit(1.0), F.lit(float(limit[0])) / width, F.lit(float(limit[1])) / height)
    side = lambda x: F.greatest(F.lit(1), F.round(x * scale).cast("int"))
    return F.struct(side(width).alias("width"), side(height).alias("height"))


def letterbox(width: Column, height: Column, to: tuple[int, int] = (224, 224)) -> Column:
    scale = F.least(F.lit(float(to[0])) / width, F.lit(float(to[1])) / height)
    side = lambda x: F.greatest(F.lit(1), F.floor(x * scale).cast("int"))
    return F.struct(side(width).alias("width"), side(height).alias("height"))


def line_texts(lines: Column) -> Column:
    """Local OCR: the texts of the lines, one a line."""
    return F.coalesce(strip(F.array_join(F.transform(lines, lambda x: x["text"]), "\n")), F.lit(""))


def page_at(pages: Column, n: Column) -> Column:
    return F.coalesce(F.get(pages, n), F.lit(""))
