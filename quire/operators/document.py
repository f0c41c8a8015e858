"""From files to text in one call: route, read, filter and send images, splice the replies, assemble."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..frames import map_frames
from ..functions import text as T
from ..sources import files as S
from ..sources import images as I
from ..storage import Table
from . import assemble as A
from . import ocr, raster
from .ledger import Ledger
from .seen import SeenHashes

KEYS = ("path", "page_no", "block_no")


def image_blocks(blocks: DataFrame) -> DataFrame:
    """image_id, path, page_no, block_no and bytes of the image blocks."""
    return blocks.where("block_type = 1").select(T.image_id(*[F.col(k) for k in KEYS]).alias("image_id"), *KEYS, "bytes")


def judged(images: DataFrame, options: ocr.Options, detector: Callable | None = None) -> DataFrame:
    """The images' scores with their keys and ``_hash``, what a duplicate is told by."""
    scope = ("path",) if options.dedup_scope == "document" else ()
    scored = raster.score(images, I.decode, detector).join(images.select("image_id", *KEYS), "image_id")
    return scored.withColumn("_hash", F.when(F.col("dhash").isNotNull(), F.concat_ws("/", *scope, "dhash")))


def survivors(images: DataFrame, options: ocr.Options, detector: Callable | None = None, seen: SeenHashes | None = None, run: int | None = None, scores: DataFrame | None = None) -> DataFrame:
    """The images that are worth a call; a duplicate is judged before its score, so a rejected first copy still stands for the others.

    With ``seen`` an image that an earlier run had is a duplicate too.
    """
    if not options.filter_images:
        return images
    scored = judged(images, options, detector) if scores is None else scores
    kept = raster.meaningful(scored, KEYS, options.min_score, options.enable_dedup, options.odd_shapes, seen, run)
    return images.join(kept.select("image_id"), "image_id", "left_semi")


def encoded(batches: DataFrame, limit: tuple[int, int] = (2048, 2048)) -> DataFrame:
    """doc_id, batch_no and images (image_id, media_type, b64) of batches of images (place, image_id, bytes), each shrunk and encoded; what cannot be decoded is left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sent = []
            for batch in frame["images"]:
                ready = []
                for image in sorted(batch, key=lambda i: i["place"]):
                    try:
                        data, kind = I.payload(bytes(image["bytes"]), limit)
                    except Exception:  # noqa: S112  the image's own failure: it is not sent
                        continue
                    ready.append({"image_id": image["image_id"], "media_type": kind, "b64": base64.b64encode(data).decode()})
                sent.append(ready)
            yield frame[["doc_id", "batch_no"]].assign(images=sent)

    return map_frames(batches, run, "doc_id string, batch_no int, images array<struct<image_id:string,media_type:string,b64:string>>").where(F.size("images") > 0)


def requests(images: DataFrame, kept: DataFrame, options: ocr.Options, prompt: str, form: str = "url") -> DataFrame:
    """doc_id (the path), batch_no, ids and parts. Batches are cut before the filter unless ``rebatch``, so a filtered image leaves a gap.

    Images are numbered and brought together by their file in one shuffle, which carries the bytes of those that are sent as they
    came; they are encoded where their batch is.
    """
    sent = kept.select("image_id", *KEYS, "bytes")
    gaps = images.select("image_id", *KEYS, F.lit(None).cast("binary").alias("bytes"))
    rows = sent if options.rebatch else sent.unionByName(gaps)
    number = F.dense_rank().over(Window.partitionBy("path").orderBy(*KEYS[1:])) - 1
    placed = rows.withColumn("_n", number).where(F.col("bytes").isNotNull())
    batch, place = F.floor(F.col("_n") / options.batch_size).cast("int"), (F.col("_n") % options.batch_size).alias("place")
    groups = placed.groupBy(F.col("path"), batch.alias("batch_no")).agg(F.collect_list(F.struct(place, "image_id", "bytes")).alias("images"))  # batch_size images at most
    ready = encoded(groups.withColumnRenamed("path", "doc_id"), options.max_image_size)
    return ready.select("doc_id", "batch_no", F.transform("images", lambda p: p["image_id"]).alias("ids"), A.prompt_parts(F.col("images"), prompt, form).alias("parts"))


def replies(spark: SparkSession, blocks: DataFrame, options: ocr.Options, make: Callable, detector: Callable | None = None, form: str = "url", ledger: Ledger | None = None, seen: SeenHashes | None = None, run: int | None = None, settings: str = "") -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(image_id, content, status) of all images sent; the calls with their usage; and the images' hashes (``_hash``), if they are filtered.

    Calls are written before they are read, so none is made twice; with a ledger none that a lost task had made either.
    """
    ocr.guard(options, make)
    images = image_blocks(blocks)
    scores = Table(spark, judged(images, options, detector)).df if options.filter_images else None
    kept = Table(spark, survivors(images, options, detector, seen, run, scores)).df
    asked = requests(images, kept, options, ocr.load_prompt(options.prompt_path), form)
    how = {"max_retries": options.max_retries, "in_flight": options.in_flight}
    calls = Table(spark, ledger.call(asked, make, settings, **how) if ledger else ocr.call(asked, make, **how)).df
    read = ocr.parse(calls)
    if options.mark_skipped:
        read = read.unionByName(A.missing(images, read, "image_id", T.NO_MEANING).withColumn("status", F.lit("skipped")), allowMissingColumns=True)
    return read, calls, scores


def kind_of(path: F.Column, status: F.Column) -> F.Column:
    """A file's kind, by its path; what was not found is of that kind."""
    return F.when(status == "not_found", "not_found").otherwise(T.route(T.extension(path)))


def read_files(spark: SparkSession, files: DataFrame, options: ocr.Options | None = None, make: Callable | None = None, detector: Callable | None = None, strict: bool = False, form: str = "url", watch: Observation | None = None, ledger: Ledger | None = None, seen: SeenHashes | None = None, run: int | None = None, settings: str = "") -> DataFrame:
    """path, part_no, kind, text, status of every file (see ``sources.files.scan``): one row a file, but one a sheet of a spreadsheet.

    With ``enable_ocr`` the images of PDF and word-processor files go to the client, and their texts come where the images were;
    without it only the text blocks are read. A file that cannot be opened has an empty text and ``open_failed``; a file
    that no reader takes has no text and its kind as status, or raises with ``strict``. ``watch`` observes files, failures and characters.
    ``ledger`` keeps replies over runs and lost tasks (``settings`` names what they depend on); with ``seen`` and a run's number, images
    of earlier runs are duplicates, and this run's are added once the text is there (see ``commit``).
    """
    options = options or ocr.Options()
    files = S.strict(files) if strict else files
    held = Table(spark, S.parts(files)).df  # files are read once
    whole, books = (held.where(F.col("block_type") == t).select("path", "text", "status") for t in (S.WHOLE, S.SHEETS))
    out = [whole.select("path", F.lit(0).alias("part_no"), "text", "status")]
    out.append(S.split(books).select("path", F.coalesce("sheet_no", F.lit(0)).alias("part_no"), "text", "status"))
    blocks = held.where(F.col("block_type") < S.WHOLE)
    if options.enable_ocr:
        found, _, scores = replies(spark, blocks, options, make, detector, form, ledger, seen, run, settings)
        if seen is not None and scores is not None:
            found = Table(spark, found).df  # before this run's hashes are there
            commit(seen, scores, run)
    ours = F.col("status") == "ok"
    image = F.when(F.col("block_type") == 1, T.image_id(*[F.col(k) for k in KEYS]))
    text = F.when(F.col("block_type") == 0, T.block_line(F.col("text"))).otherwise(F.lit(""))
    lines = blocks.where(ours).select(*KEYS, image.alias("image_id"), text.alias("text"))
    lines = A.with_replies(lines, found) if options.enable_ocr else lines
    whole = A.documents(A.pages(lines, ("path", "page_no")), "path", "page_no").select("path", "text", F.lit("ok").alias("status"))
    failed = blocks.where(~ours).select("path", F.lit("").alias("text"), "status")
    out.append(whole.unionByName(failed).select("path", F.lit(0).alias("part_no"), "text", "status"))
    result = reduce(DataFrame.unionByName, out).select("path", "part_no", kind_of(F.col("path"), F.col("status")).alias("kind"), "text", "status")
    if watch is not None:
        result = result.observe(watch, F.count("*").alias("rows"), F.count(F.when(F.col("status") != "ok", 1)).alias("failures"), F.sum(F.length("text")).alias("characters"))
    return result


def commit(seen: SeenHashes, scores: DataFrame, run: int) -> None:
    """Adds a run's image hashes, those of images too small to be judged left out."""
    big = scores.where((F.col("status") == "ok") & (F.col("width") >= raster.MIN_SIDE) & (F.col("height") >= raster.MIN_SIDE))
    seen.commit(big, "_hash", run)
