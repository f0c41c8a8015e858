"""From blocks to pages to documents. Aggregation is partial per key; order travels with the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def _ordered(value: str, order: str, sep: str) -> F.Column:
    rows = F.array_sort(F.collect_list(F.struct(F.col(order), F.coalesce(F.col(value), F.lit("")).alias("v"))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), sep)


def block_text(blocks: DataFrame) -> DataFrame:
    """Text of each block of type 0 (lines) or 1 (image); others go. Adds ``text``."""
    text = F.when(F.col("block_type") == 0, T.block_line(T.spans_text(F.col("lines")))).otherwise(T.placeholder(F.col("image_id")))
    return blocks.where(F.col("block_type").isin(0, 1)).withColumn("text", text)


def pages(blocks: DataFrame, keys: tuple[str, ...] = ("doc_id", "page_no"), order: str = "block_no") -> DataFrame:
    return blocks.groupBy(*keys).agg(_ordered("text", order, "").alias("text"))


def documents(pages_: DataFrame, key: str = "doc_id", order: str = "page_no") -> DataFrame:
    return pages_.groupBy(key).agg(_ordered("text", order, "\n\n").alias("text"))


def with_replies(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """Image blocks get their text by key, or nothing. Text blocks keep theirs and take no part in the join, where their missing ids would meet."""
    found = replies.select("image_id", F.col("content").alias("_content"))
    images = blocks.where(F.col("image_id").isNotNull()).join(found, "image_id", "left")
    images = images.withColumn("text", F.concat(T.strip(F.coalesce("_content", F.lit(""))), F.lit("\n"))).select(*blocks.columns)
    return blocks.where(F.col("image_id").isNull()).unionByName(images)


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def missing(expected: DataFrame, found: DataFrame, key: str, message: str) -> DataFrame:
    """The expected keys that were not found, with a message in their place."""
    return expected.select(key).join(found.select(key), key, "left_anti").withColumn("content", F.lit(message))


def batches(images: DataFrame, size: int = 5, scope: str = "doc_id", order: tuple[str, ...] = ("page_no", "block_no")) -> DataFrame:
    """batch_no by document, before any filter."""
    if not 1 <= size <= 5:
        raise ValueError("a batch holds 1 to 5 images")
    number = F.row_number().over(Window.partitionBy(scope).orderBy(*order)) - 1
    return images.withColumn("batch_no", F.floor(number / size).cast("int")).withColumn("place", (number % size + 1).cast("int"))


def first_seen(rows: DataFrame, hash_: str, order: tuple[str, ...]) -> DataFrame:
    """The first row of each hash; rows without a hash all stay, and of rows that share hash and order one stays.

    One shuffle: the first row so far is kept in each task before it, so copies of one image do not meet.
    """
    whole = F.struct(*[F.col(c) for c in rows.columns])
    firsts = rows.where(F.col(hash_).isNotNull()).groupBy(F.col(hash_).alias("_hash_")).agg(F.min_by(whole, F.struct(*order)).alias("_row"))
    return firsts.select("_row.*").unionByName(rows.where(F.col(hash_).isNull()))


def unseen(rows: DataFrame, seen: DataFrame, hash_: str) -> DataFrame:
    """Incremental form: rows whose hash is not in a table of earlier runs."""
    return rows.join(seen.select(hash_), hash_, "left_anti")


PROMPT_PART = "struct<type:string,text:string,url:string,media_type:string,data:string>"


def _part(type_: str, text=None, url=None, media=None, data=None) -> F.Column:
    null = F.lit(None).cast("string")
    return F.struct(F.lit(type_).alias("type"), (null if text is None else text).alias("text"), (null if url is None else url).alias("url"), (null if media is None else media).alias("media_type"), (null if data is None else data).alias("data"))


def prompt_parts(parts: F.Column, prompt: str, form: str = "url") -> F.Column:
    """Message of a batch: parts is an array of (image_id, media_type, b64). Forms: url, source, numbered."""
    head = F.array(_part("text", F.lit(prompt)))
    if form == "url":
        each = F.transform(parts, lambda p: F.array(_part("text", F.concat(F.lit("[ID: "), p["image_id"], F.lit("]\n"))), _part("image_url", url=F.concat(F.lit("data:"), p["media_type"], F.lit(";base64,"), p["b64"]))))
        return F.concat(head, F.flatten(each))
    if form == "source":
        tag = lambda open_, p, end: F.concat(F.lit(open_), p["image_id"], F.lit(end))
        each = F.transform(parts, lambda p: F.array(_part("text", tag('<file image_id="', p, '">\n')), _part("image", media=p["media_type"], data=p["b64"]), _part("text", tag('\n</file image_id="', p, '">\n\n'))))
        return F.concat(head, F.flatten(each))
    each = F.transform(parts, lambda p, i: F.array(_part("text", F.concat(F.lit("Image "), (i + 1).cast("string"), F.lit(". Image ID: "), p["image_id"])), _part("image", media=F.lit("image/jpeg"), data=p["b64"])))
    return F.concat(F.flatten(each), head)
